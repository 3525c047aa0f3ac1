"""DataFrame helpers of the training-data operators."""
from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import application_id, scratch_path
from . import kernel as K


def map_texts(docs: DataFrame, id_col: str, text_col: str, fields: str,
              rows: Callable[[pa.RecordBatch], list], limit: int = K.CHUNK_BYTES,
              max_rows: int = K.CHUNK_ROWS) -> DataFrame:
    """(id, *fields) of each row. `rows` gets slices with the columns id and text, bounded
    in bytes, and returns the arrays of id and fields. Only id and text are read, so other
    columns of `docs` can have any name."""
    names = ["id", *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, limit=limit, rows=max_rows):
                yield pa.RecordBatch.from_arrays(rows(part), names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, {fields}").withColumnRenamed("id", id_col))


def keep_texts(docs: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of `docs`, all columns, whose text `keep` wants: no join, no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, text_col):
                yield part.filter(pa.array(keep(part.column(at)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))


def decided(labels: DataFrame, id_col: str, label_col: str, name: str) -> DataFrame:
    """(id, name int): one 0/1 label of each id, the more frequent one where rows differ, 1 where
    both are as frequent. Null ids and null labels have no say."""
    rows = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias(name)).dropna()
    return rows.groupBy("id").agg((2 * F.sum(name) >= F.count(name)).cast("int").alias(name))


def sampled(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About `bound` of the rows at most (all of them if there are fewer), chosen by a hash
    of the id: for fitting a classifier on a bounded sample of labelled rows."""
    n = rows.count()
    if n <= bound:
        return rows
    grain = 1 << 62  # finer than any share of a table
    return rows.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(grain)) < grain * bound // n)


_STORED: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """`df` written as a table in the shared folder and read again: cuts the lineage where
    rows are used more than once, survives lost executors, and tells the planner the true
    size. The folders go when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    paths = _STORED.setdefault(application_id(spark), [])
    if not paths:
        atexit.register(_drop, spark, paths)
    paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, paths: list[str]) -> None:
    """Best effort at the end of the application: the session may be gone already."""
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()
