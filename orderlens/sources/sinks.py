"""Writers: ingest stamp, idempotent partition overwrites, whole replacements in versions
(`versions`), observed row counts, and tables published to the catalog and kept in line.

Row counts are taken with `DataFrame.observe` while the write runs, so reporting them
does not execute the lineage a second time.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from ..session import codec
from . import versions


def stamp_ingest(df: DataFrame, source: str, batch_date: str | _dt.date | None = None) -> DataFrame:
    """Add ingest metadata: ingest_ts (now), source label, batch_date (DATE; today when
    not given)."""
    bd = F.lit(str(batch_date)).cast("date") if batch_date is not None else F.current_date()
    return df.withColumns({"ingest_ts": F.current_timestamp(), "source": F.lit(source),
                           "batch_date": bd})


def _observed(df: DataFrame, name: str, more: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    out = df.write.format(fmt)
    return out.option("compression", codec(df.sparkSession)) if fmt == "parquet" else out


def _written(df: DataFrame, path: str, obs: Observation) -> int:
    """After a write: drop cached data and file listings of `path`, return the rows written."""
    df.sparkSession.catalog.refreshByPath(path)
    return int(obs.get["rows"])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", keep: int = versions.KEEP,
                observe: Sequence[Column] = (), figures: dict | None = None) -> int:
    """Replace the whole table (schema included) by a new version: readers see the old rows
    until all new ones are there. Returns the rows written. `observe` are aggregates taken on
    the way, put into `figures` by their names."""
    df, obs = _observed(df, "write_table", observe)
    name, folder = versions.begin(path)
    _writer(df, fmt).save(folder)
    versions.commit(df.sparkSession, path, name, keep)
    if figures is not None:
        figures.update(obs.get)
    return _written(df, path, obs)


def write_table_in_parts(parts: Sequence[DataFrame], path: str, fmt: str = "parquet", keep: int = versions.KEEP) -> int:
    """`write_table` of a table that comes in parts (at least one), written one after the other: the
    version is committed when all are there."""
    name, folder = versions.begin(path)
    rows = 0
    for part in parts:
        df, obs = _observed(part, "write_table")
        _writer(df, fmt).mode("append").save(folder)
        rows += int(obs.get["rows"])
    versions.commit(df.sparkSession, path, name, keep)
    df.sparkSession.catalog.refreshByPath(path)
    return rows


def write_partitions(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet",
                     observe: Sequence[Column] = (), figures: dict | None = None) -> int:
    """Replace only the partitions present in `df` (dynamic partition overwrite): a
    re-run of the same date replaces that date and leaves every other one alone."""
    df, obs = _observed(df, "write_partitions", observe)
    (_writer(df, fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).save(path))
    if figures is not None:
        figures.update(obs.get)
    return _written(df, path, obs)


def write_batch(df: DataFrame, path: str, batch_date=None, fmt: str = "parquet") -> int:
    """Bronze landing. With a batch date only that `batch_date` partition is replaced (an
    empty extract leaves an empty one: the date has a batch, and the table its columns);
    without one the whole table is replaced."""
    if batch_date is None:
        df, obs = _observed(df, "write_batch")
        _writer(df, fmt).mode("overwrite").partitionBy("batch_date").save(path)
        return _written(df, path, obs)
    rows = write_partitions(df, path, "batch_date", fmt)
    if not rows:
        empty_partition(df, path, "batch_date", batch_date, fmt)
    return rows


def empty_partition(df: DataFrame, path: str, partition_col: str, value, fmt: str = "parquet") -> None:
    """Replace one partition by an empty one with the columns of `df`: a dynamic overwrite
    touches no partition without rows."""
    folder = f"{path.rstrip('/')}/{partition_col}={value}"
    df.limit(0).drop(partition_col).coalesce(1).write.mode("overwrite").format(fmt).save(folder)
    df.sparkSession.catalog.refreshByPath(path)


def upsert_snapshots(clv: DataFrame, path: str, fmt: str = "parquet", observe: Sequence[Column] = (), figures: dict | None = None) -> int:
    """CLV snapshots partitioned by snapshot_date; a rerun replaces only its dates."""
    return write_partitions(clv, path, "snapshot_date", fmt, observe, figures)


def publish_tables(spark: SparkSession, database: str, root: str, tables: list[str],
                   partitioned: dict[str, str] | None = None, fmt: str = "parquet") -> list[str]:
    """Register each `<root>/<table>` as an external table `<database>.<table>`,
    replacing an earlier registration so schema changes are picked up."""
    partitioned = partitioned or {}
    # The database lives with the Gold zone (shared storage), not in the default
    # warehouse folder, which is machine-local when the cluster does not set one.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root.rstrip('/')}'")
    names = []
    for t in tables:
        path = f"{root.rstrip('/')}/{t}"
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}`")
        spark.catalog.createTable(f"{database}.{t}", path=versions.resolve(spark, path), source=fmt)
        spark.sql(f"ALTER TABLE `{database}`.`{t}` SET TBLPROPERTIES ('{_ROOT}' = '{path}')")
        if t in partitioned:
            spark.catalog.recoverPartitions(f"{database}.{t}")
        names.append(f"{database}.{t}")
    return names


#: The table property that names the folder a published table was registered for.
_ROOT = "orderlens.root"


def reconcile(spark: SparkSession, table: str) -> None:
    """Bring a published table in line with its folder, whoever wrote there: partitions that
    were added or removed, or the current version of a table replaced whole."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    else:
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        if _ROOT in found:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{versions.resolve(spark, found[_ROOT])}'")
    spark.catalog.refreshTable(table)


def read_published(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A published table by name, as its folder is now."""
    reconcile(spark, f"{database}.{table}")
    return spark.table(f"{database}.{table}")
