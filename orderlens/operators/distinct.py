"""Several exact distinct counts beside plain aggregates.

Spark computes them in one aggregate by an `Expand` that repeats every input row, with all
columns that the plain aggregates need, once for each distinct count. Here the values to be
counted are rows of their own, (group, name, value), reduced map-side to one of each; the
plain aggregates run over rows that nothing repeats.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def distinct_counts(df: DataFrame, columns: dict[str, Column], group: Sequence[str] = ()) -> DataFrame:
    """(group, name...) with the number of different non-null values of each column: one row a
    group that has any, one row in all without a group."""
    each = [F.struct(F.lit(name).alias("of"), c.cast("string").alias("value")) for name, c in columns.items()]
    values = df.select(*group, F.explode(F.array(*each)).alias("x")).select(*group, "x.of", "x.value").filter("value IS NOT NULL")
    counts = [F.count_if(F.col("of") == name).alias(name) for name in columns]
    return values.groupBy(*group, "of", "value").agg(F.lit(1).alias("one")).groupBy(*group).agg(*counts)
