"""Session helpers.

The engine needs three things from a session: UTC as the session time zone (order
timestamps are UTC instants and `to_date` must not shift them), adaptive execution
(runtime coalescing — cached inputs included — skew-join splitting, runtime broadcast of
small sides), and a reliable checkpoint directory for the few places where lineage is
cut on purpose.
"""
from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings every job relies on. They are SQL confs, so they can be applied to
# a session somebody else created as well as to one built here.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let adaptive execution re-plan (coalesce, split) what is cached; otherwise a cached plan keeps every one of spark.sql.shuffle.partitions tasks.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # A join whose smaller side came out small in every partition builds a hash table of it
    # (bounded by this size) instead of sorting both sides, of which the larger would spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}
#: Bytes of a file that one task reads: what a task makes of them, such as one row a snapshot of
#: each customer's state, is sorted or grouped there.
SCAN_BYTES = 32 << 20
#: Texts and sets of a document take kilobytes: rows that a Python worker holds at once.
ARROW_ROWS = 2_000
#: And at most so many bytes, whatever the length of a text: the JVM builds the batch outside
#: its heap, and the worker holds the batch it works on and the one that it reads.
ARROW_BYTES = 2 << 20
#: The same for a query whose sums are rounded batch by batch: about 2,000 usual texts.
ARROW_BYTES_WIDE = 64 << 20
#: Bytes of Parquet input for each partition that a shuffle is dealt into: rows of the sources
#: are about 15 times as large in memory, so a task sorts or groups about 64 MB of them.
SHUFFLE_INPUT_BYTES = 4 << 20
#: Parquet bytes that one pass may read, where a step is done pass after pass (`split`). Rows take up to four times
#: as much in shuffle files as in Parquet; those of a pass go before the next one starts.
PASS_BYTES = 1280 << 20


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "orderlens", driver_memory: str = "8g") -> SparkSession:
    """Local/dev session. On a cluster, use the session the platform provides and call
    `prepare(spark)` on it instead."""
    master = master or os.environ.get("ORDERLENS_MASTER", "local[*]")
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the engine's SQL confs and make sure a checkpoint directory exists."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, most in (("spark.sql.files.maxPartitionBytes", SCAN_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
                    ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        if not 0 < _bytes(spark.conf.get(k)) <= most:
            spark.conf.set(k, str(most))
    checkpoint_root(spark)
    return spark


def widen_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ARROW_BYTES_WIDE, until the next `prepare`; a bound of the user's stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(ARROW_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES_WIDE))


def _bytes(text: str) -> int:
    """A number as Spark's settings write it, with a unit of bytes or without."""
    unit = text.strip().lower().removesuffix("b").lstrip("-0123456789")
    return int(text.strip().lower().removesuffix("b").removesuffix(unit)) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def spare_disk(spark: SparkSession) -> None:
    """Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage (a
    DataFrame that is run again makes them again)."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def codec(spark: SparkSession) -> str:
    """The codec of the Parquet tables: zstd, unless another than Spark's default is set."""
    named = spark.conf.get("spark.sql.parquet.compression.codec")
    return "zstd" if named == "snappy" else named


def _scanned(df) -> int:
    """Bytes of the files that `df` scans, less the columns that it leaves out, as the planner estimates them; 0 if unknown."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - not available on every session kind
        return 0


def passes(*scans: DataFrame) -> int:
    """The number of passes for a step that shuffles what these scans read: PASS_BYTES each."""
    return max(1, -(-sum(map(_scanned, scans)) // PASS_BYTES))


def split(df: DataFrame, n: int, *keys: str) -> list[DataFrame]:
    """`df` in `n` parts, together all of its rows; rows with equal keys (null equals null) are in the same part, also
    of another DataFrame split by these keys."""
    if n < 2:
        return [df]
    part = F.pmod(F.xxhash64(*keys), F.lit(n))
    return [df.filter(part == i) for i in range(n)]


def in_passes(df: DataFrame, keys: Sequence[str], build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """`build(df)`, where no row of the result is made of rows with different keys. Of a large scan, part after part, each
    stored: the disk holds the shuffle files of one part at a time."""
    parts = split(df, passes(df), *keys)
    if len(parts) == 1:
        return build(df)
    return reduce(DataFrame.unionByName, [stored(build(part), name) for part in parts])


def deal_out(spark: SparkSession, df) -> int:
    """Deal shuffles into as many partitions as the files that `df` scans call for, never fewer
    than the session has: with a fixed number, the tasks of a larger input hold more and
    spill. Adaptive execution joins small ones again. Returns the number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, -(-_scanned(df) // SHUFFLE_INPUT_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def _context(spark: SparkSession):
    """The classic SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - not available on every session kind
        return None


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "session")


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (`spark.checkpoint.dir`, or one
    already set on the context). Only a local session without either gets a private
    folder; on a cluster that is an error."""
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_STORED: dict[str, list[str]] = {}
_HERE: ContextVar[list[str] | None] = ContextVar("stored_here", default=None)


def stored(df, name: str):
    """`df` written to the shared scratch folder and read again: for rows that are read several
    times. Survives lost executors and tells the planner the true size. The folders go when the
    application ends, or the step that they are `released` with."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec(spark))
    paths = _HERE.get()
    if paths is None:
        paths = _STORED.setdefault(application_id(spark), [])
        if not paths:
            atexit.register(drop, spark, paths)
    paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def released(spark: SparkSession):
    """What is `stored` inside, by this thread, goes at the end: for a step that writes its results elsewhere. Gives
    the folders so far, for `drop`."""
    paths: list[str] = []
    token = _HERE.set(paths)
    try:
        yield paths
    finally:
        _HERE.reset(token)
        drop(spark, paths)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Best effort: at the end of the application, the session may be gone already."""
    sc = _context(spark)
    if sc is not None:
        with contextlib.suppress(Exception):
            for path in paths:
                at = sc._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, for jobs that must write a table
    and read it back (sink round trips). Never a machine-local temp folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/orderlens-scratch/{name}-{uuid.uuid4().hex}"
