"""Exact global ranking without funnelling a group through one task.

`Window.orderBy(...)` with no (or a coarse) partition key sorts the whole input in a
single task — for a customer table ranked by spend that is every customer in one task.
`ordered_positions` computes the same 1-based positions distributed:

1. range-partition the rows on (group keys, order keys) and sort inside each range —
   Spark's range partitioner samples the keys and routes rows by binary search, so
   every range holds a similar share, including when many rows tie on the order key
   (the caller's tiebreak column keeps the order total);
2. tag each row with its range (`spark_partition_id`) and its place inside the range
   (`monotonically_increasing_id` after the sort) and **checkpoint**: the range bounds
   come from a sample, so a recomputed partition (e.g. after an executor loss) could
   land on different bounds; the reliable checkpoint fixes membership and tags;
3. count rows per (group, range) — a table of size groups × ranges — and turn the counts
   into running offsets with a small window;
4. position = offset of the row's (group, range) + place inside the range.

The number of ranges follows from an aggregate row count, up to MAX_RANGES; a small input is
one range of the same plan. method="window" (Spark's window function, one task a group) is
kept for comparison in the tests. Quantiles don't need positions: see `cutpoints`.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_root, stored

_TMP = ["_rk_part", "_rk_seq", "_rk_first", "_rk_before", "_rk_cnt"]

# Rows that one range sorts, and the most ranges (beyond them, ranges grow).
ROWS_PER_RANGE, MAX_RANGES = 100_000, 10_000


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_positions(df: DataFrame, order_by: Sequence, partition_by: Sequence[str] = (),
                      num_ranges: int | None = None, pos_col: str = "_pos",
                      size_col: str = "_n") -> DataFrame:
    """Add `pos_col` (1-based position of the row within its `partition_by` group under
    `order_by`) and `size_col` (the group's row count). `order_by` must be a total order
    (end it with a unique column)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = [F.col(g).asc() for g in partition_by] + [_as_col(c) for c in order_by]

    # The input is read twice (key sample for the range bounds, then the routing pass);
    # store it so the upstream aggregate runs once and its shuffle files can go.
    source = stored(df, "rank-rows")
    if num_ranges is None:
        num_ranges = min(max(-(-source.count() // ROWS_PER_RANGE), 1), MAX_RANGES)
    staged = (source.repartitionByRange(num_ranges, *keys)
              .sortWithinPartitions(*keys)
              .withColumns({"_rk_part": F.spark_partition_id(),
                            "_rk_seq": F.monotonically_increasing_id()}))
    staged = staged.checkpoint(eager=True)

    groups = list(partition_by)
    stats = staged.groupBy(*groups, "_rk_part").agg(F.count(F.lit(1)).alias("_rk_cnt"),
                                                    F.min("_rk_seq").alias("_rk_first"))
    # groups × ranges rows: small, so an unpartitioned window here is cheap.
    running = Window.partitionBy(*groups).orderBy("_rk_part")
    stats = stats.select(
        *groups, "_rk_part", "_rk_first",
        F.coalesce(F.sum("_rk_cnt").over(
            running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rk_before"),
        F.sum("_rk_cnt").over(Window.partitionBy(*groups)).alias(size_col),
    )
    cond = [staged["_rk_part"] == stats["_rk_part"]] + [staged[g].eqNullSafe(stats[g]) for g in groups]
    joined = staged.join(stats, cond).drop(stats["_rk_part"])
    for g in groups:
        joined = joined.drop(stats[g])
    out = joined.withColumn(pos_col, F.col("_rk_before") + (F.col("_rk_seq") - F.col("_rk_first")) + 1)
    return out.drop(*[c for c in _TMP if c in out.columns])


def row_number(df: DataFrame, order_by: Sequence, partition_by: Sequence[str] = (),
               out_col: str = "row_number", method: str = "distributed",
               num_ranges: int | None = None) -> DataFrame:
    """`df` with `out_col` = ROW_NUMBER() over (partition_by, order_by)."""
    if method == "window":
        w = Window.partitionBy(*partition_by).orderBy(*[_as_col(c) for c in order_by])
        return df.withColumn(out_col, F.row_number().over(w).cast("int"))
    pos = ordered_positions(df, order_by, partition_by, num_ranges=num_ranges,
                            pos_col=out_col, size_col="_rn_n")
    return pos.withColumn(out_col, F.col(out_col).cast("int")).drop("_rn_n")
