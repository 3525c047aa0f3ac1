"""Readers: raw sources (CSV, JDBC), zone tables and the Gold registry.

Raw sources arrive as text and are never type-inferred: a CSV is read with its header
and every column as a string, names are lower-cased, and the contract columns are
selected by name (so a reordered file still maps correctly).
"""
from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..contracts import GOLD_TABLES, SOURCE_COLUMNS
from ..operators.cleaning import standardize_casing
from ..session import stored
from . import versions


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             multiline: bool = False) -> DataFrame:
    """Header CSV, all strings. `multiline` accepts RFC-4180 quoted fields that contain
    line breaks (quote and escape are both `"`); such a file cannot be split, so land it
    once (Bronze parquet) rather than re-reading it. Every file's header is checked: one
    that orders or names its columns differently from the others fails the read."""
    r = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    if multiline:
        r = r.option("multiLine", True).option("quote", '"').option("escape", '"')
    df = standardize_casing(r.csv(path))
    return df.select(*columns) if columns else df


class CsvRead(NamedTuple):
    """Rows that could be read, by contract; lines that couldn't, with file and reason."""

    rows: DataFrame
    rejects: DataFrame


def csv_headers(spark: SparkSession, path: str, threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder or pattern by their header, lower-cased: one short read a file, of
    the list of files that every reader of the folder makes. A file without a line has no header."""
    def first_line(file: str) -> str | None:
        at = spark._jvm.org.apache.hadoop.fs.Path(file)
        stream = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(at)
        try:
            return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(max_workers=threads) as pool:
        lines = list(pool.map(first_line, files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            header = tuple(c.strip().lower() for c in next(csv.reader([line.removeprefix("\ufeff")])))
            groups.setdefault(header, []).append(file)
    return groups


def read_csv_groups(spark: SparkSession, path: str, columns: list[str], multiline: bool = False) -> CsvRead:
    """Header CSV files that order their columns differently, or have more of them: each group
    of files with one header is read by it, and the groups are united by name. A line with too
    few or too many fields is no row; it is written to the shared scratch folder as text, with its
    file and the reason. A file that lacks a contract column is an error."""
    rows, rejects = [], []
    for header, files in csv_headers(spark, path).items():
        if missing := sorted({*columns} - {*header}):
            raise ValueError(f"{files[0]} and {len(files) - 1} more lack the columns {missing}")
        kind = StructType([StructField(c, StringType()) for c in (*header, _BAD)])
        r = spark.read.schema(kind).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).option("columnPruning", False)
        if multiline:
            r = r.option("multiLine", True).option("quote", '"').option("escape", '"')
        df = r.csv(files).select("*", F.col("_metadata.file_path").alias("_file"))
        # Absent trailing fields are null; a line with too many fills all of them.
        reason = F.when(F.col(f"`{header[-1]}`").isNull(), F.lit("too few fields")).otherwise(F.lit("too many fields"))
        rows.append(df.filter(F.col(_BAD).isNull()).select(*columns))
        rejects.append(df.filter(F.col(_BAD).isNotNull()).select(F.col("_file").alias("file"), reason.alias("reason"), F.col(_BAD).alias("line")))
    if not rows:
        empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        return CsvRead(empty, spark.createDataFrame([], "file string, reason string, line string"))
    return CsvRead(reduce(DataFrame.unionByName, rows), stored(reduce(DataFrame.unionByName, rejects), "csv-rejects"))


_BAD = "_bad_line"


def read_jdbc(spark: SparkSession, url: str, table: str, user: str, password: str,
              driver: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A relational table over JDBC. Credentials are passed in by the caller and never
    stored. With `partition_column` and bounds, Spark issues `num_partitions` range
    queries in parallel instead of one full-table read in a single task."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("user", user).option("password", password).option("fetchsize", fetch_size))
    if driver:
        r = r.option("driver", driver)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return standardize_casing(r.load())


@dataclass
class SourceSpec:
    """Where one raw source table comes from.

    mode: "csv" (path, multiline), "jdbc" (options for `read_jdbc`) or "parquet" (path).
    """
    mode: str
    path: str | None = None
    multiline: bool = False
    jdbc: dict = field(default_factory=dict)


def read_source(spark: SparkSession, table: str, spec: SourceSpec) -> DataFrame:
    """One raw source table by mode, projected onto its contract columns."""
    cols = SOURCE_COLUMNS.get(table)
    if spec.mode == "csv":
        return read_csv(spark, spec.path, cols, multiline=spec.multiline)
    if spec.mode == "jdbc":
        df = read_jdbc(spark, **spec.jdbc)
    elif spec.mode == "parquet":
        df = standardize_casing(spark.read.parquet(spec.path))
    else:
        raise ValueError(f"unknown source mode {spec.mode!r}")
    return df.select(*cols) if cols else df


def zone_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_zone(spark: SparkSession, root: str, table: str, fmt: str = "parquet", back: int = 0) -> DataFrame:
    """A Bronze/Silver/Gold table by zone root and name: the current version of one that is
    replaced whole, or the one `back` before it. Partitions may have been written with
    different columns (a column added later): their schemas are merged."""
    path = versions.resolve(spark, zone_path(root, table), back)
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)


def read_gold(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A published Gold table; unknown names raise KeyError. The caller projects the
    columns it needs, so the scan reads only those."""
    if table not in GOLD_TABLES:
        raise KeyError(f"unknown Gold table: {table}")
    return read_zone(spark, root, table, fmt)
