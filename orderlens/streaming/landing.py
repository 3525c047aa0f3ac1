"""Landing-folder ingest with Structured Streaming.

Extracts dropped as CSV files into a landing folder are ingested into Bronze exactly
once: the file source's checkpoint remembers which files were processed (what job
bookmarks are meant to do), and `trigger(availableNow=True)` turns each run into a
bounded batch job — process what has arrived, then stop.

Each micro-batch is stamped like a batch ingest and replaces the whole folder of its id
(`stream_batch=<id>/batch_date=<date>`). If a run dies after writing but before its
checkpoint commit, the retried micro-batch keeps its id and replaces what it wrote, also
when it is retried on a later date, so nothing is landed twice.

Such a Bronze table holds increments: a reader takes all of its batches, where a table of
full extracts is read by its latest batch (`plans.daily.read_bronze_batch`).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contracts import SOURCE_COLUMNS, string_schema
from ..session import codec
from ..sources.sinks import stamp_ingest

STREAM_BATCH_COL = "stream_batch"


def landing_stream(spark: SparkSession, landing_dir: str, table: str,
                   multiline: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the CSV files of one source table. Header names are
    checked against the contract (case-insensitively), never inferred."""
    cols = SOURCE_COLUMNS[table]
    r = (spark.readStream.schema(string_schema(cols)).option("header", True)
         .option("enforceSchema", False))
    if multiline:
        r = r.option("multiLine", True).option("quote", '"').option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing_dir)


def ingest_landing(spark: SparkSession, landing_dir: str, table: str, bronze_path: str,
                   checkpoint_dir: str, source_label: str = "landing", batch_date=None,
                   multiline: bool = False) -> None:
    """Process every file that has arrived in `landing_dir` since the last run into the
    Bronze table at `bronze_path`, then return."""

    def write_micro_batch(df: DataFrame, batch_id: int) -> None:
        (stamp_ingest(df, source_label, batch_date).write.mode("overwrite").option("compression", codec(spark))
         .option("partitionOverwriteMode", "static").partitionBy("batch_date")
         .parquet(f"{bronze_path}/{STREAM_BATCH_COL}={batch_id}"))

    q = (landing_stream(spark, landing_dir, table, multiline=multiline).writeStream
         .foreachBatch(write_micro_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
