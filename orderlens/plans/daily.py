"""The daily job chain over zone folders: ingest → Silver → CLV ∥ marts → QC + publish.

Every step reads what the previous step wrote (parquet), so each one starts from a cut
lineage: a lost executor costs a re-read of the step's input, not a recomputation of
the whole chain, and no table is computed twice for two writes. Re-running a date is
idempotent: Bronze replaces that `batch_date`, Silver and marts are replaced whole from
the latest batch (so reloading an older date doesn't roll them back), and CLV replaces
only the snapshot dates it computed.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..contracts import GOLD_TABLES, SILVER_TABLES, SOURCE_COLUMNS
from ..operators import calendar as cal_ops
from ..operators import cleaning, grain, quality, refresh
from ..operators import marts as mart_ops
from ..session import _context, drop, passes, prepare, released, spare_disk, split, stored
from ..sources.readers import read_zone, zone_path
from ..sources.sinks import empty_partition, publish_tables, stamp_ingest, upsert_snapshots, write_batch, write_table, write_table_in_parts
from ..streaming.landing import STREAM_BATCH_COL
from . import jobs
from .sql_views import publish_views

CLV_TABLE = "g_fact_customer_clv_daily"


@dataclass(frozen=True)
class Zones:
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, root: str) -> "Zones":
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold")


def ingest(sources: dict[str, DataFrame], zones: Zones, source_label: str,
           batch_date=None) -> dict[str, int]:
    """E1: land each raw source in Bronze as `b_<table>`, stamped, one batch_date
    partition per run."""
    counts = {}
    for table, df in sources.items():
        stamped = stamp_ingest(df.select(*SOURCE_COLUMNS[table]), source_label, batch_date)
        counts[f"b_{table}"] = write_batch(stamped, zone_path(zones.bronze, f"b_{table}"), batch_date)
    return counts


def read_bronze_batch(spark: SparkSession, zones: Zones, table: str, batch_date=None) -> DataFrame:
    """One Bronze batch (default: the latest) of a table of full extracts: reading every
    batch would double each order once two extracts coexist. The batch filter is a
    partition filter; the default latest date is a scalar subquery the scan prunes with
    at run time. Of a table landed in increments: all of them, up to `batch_date` if it
    is given."""
    b = read_zone(spark, zones.bronze, f"b_{table}")
    if STREAM_BATCH_COL in b.columns:
        upto = b if batch_date is None else b.filter(F.col("batch_date") <= F.lit(str(batch_date)).cast("date"))
        return upto.select(*SOURCE_COLUMNS[table])
    bd = (F.lit(str(batch_date)).cast("date") if batch_date is not None
          else b.select(F.max("batch_date")).scalar())
    return b.filter(F.col("batch_date") == bd).select(*SOURCE_COLUMNS[table])


def write_silver(spark: SparkSession, items_raw: DataFrame, options_raw: DataFrame,
                 dev_app_name: str, silver_root: str, figures: dict | None = None, raw_passes: int = 1) -> dict[str, int]:
    """Clean raw sources into the five Silver tables under `silver_root`. The two cleaned
    tables are written first and read back, so the calendar, line and order tables start
    from parquet rather than from the raw lineage. Independent writes (items ∥ options,
    calendar ∥ lines) are submitted together so their stages share the cluster. `figures` gets
    the number of lines expected in Silver (those read without those dropped for a reason,
    counted while they are read) and of those written.

    Large inputs go through in passes over their orders, so the disk holds the shuffle files of one pass
    beside the tables: lines and orders in as many as their tables call for, the raw lines
    in `raw_passes` (more than one is of use where reading them shuffles rows)."""
    def path(t: str) -> str:
        return zone_path(silver_root, t)

    spare_disk(spark)
    reads: list[Observation] = []

    def cleaned(raw: DataFrame) -> DataFrame:
        reads.append(Observation(f"raw_lines_{len(reads)}"))
        return cleaning.clean_order_items(raw.observe(reads[-1], *cleaning.line_counts(dev_app_name)), dev_app_name)

    items = [cleaned(raw) for raw in split(cleaning.standardize_casing(items_raw), raw_passes, "order_id")]
    options = cleaning.clean_order_item_options(options_raw)
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_items = pool.submit(write_table_in_parts, items, path("s_order_items"))
        f_opts = pool.submit(write_table, options, path("s_order_item_options"))
        counts = {"s_order_items": f_items.result(), "s_order_item_options": f_opts.result()}
    if figures is not None:
        read = {reason: sum(r.get[reason] for r in reads) for reason in reads[0].get}
        figures |= {"items": counts["s_order_items"], "expected": quality.expected_lines(read), "lines_read": read}
    items = read_zone(spark, silver_root, "s_order_items")
    options = read_zone(spark, silver_root, "s_order_item_options")
    n = passes(items, options)
    joined = [grain.build_order_lines(*part) for part in zip(split(items, n, "order_id"), split(options, n, "order_id"))]
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_cal = pool.submit(lambda: write_table(
            cal_ops.generate_calendar(cal_ops.date_bounds(items)), path("s_date_dim")))
        f_lines = pool.submit(write_table_in_parts, joined, path("s_order_lines"))
        counts["s_date_dim"], counts["s_order_lines"] = f_cal.result(), f_lines.result()
    lines = read_zone(spark, silver_root, "s_order_lines")
    n = passes(lines.select(*grain.ORDER_KEYS, "net_line"))
    counts["s_orders"] = write_table_in_parts([grain.build_orders(part) for part in split(lines, n, "order_id")], path("s_orders"))
    return counts


def silver(spark: SparkSession, zones: Zones, dev_app_name: str, batch_date=None, figures: dict | None = None) -> dict[str, int]:
    """E2: clean one Bronze batch into Silver."""
    return write_silver(spark, read_bronze_batch(spark, zones, "order_items", batch_date),
                        read_bronze_batch(spark, zones, "order_item_options", batch_date),
                        dev_app_name, zones.silver, figures)


def read_silver(spark: SparkSession, zones: Zones | str) -> dict[str, DataFrame]:
    root = zones.silver if isinstance(zones, Zones) else zones
    return {t: read_zone(spark, root, t) for t in SILVER_TABLES}


def clv(spark: SparkSession, zones: Zones, run_date=None, backfill: bool = False, figures: dict | None = None) -> int:
    """E3: daily snapshot (or month-end backfill) upserted by snapshot_date. Of a daily one,
    `figures` gets the tiers."""
    with released(spark):
        df = jobs.build_clv(spark, read_silver(spark, zones), run_date=run_date, backfill=backfill)
        return upsert_snapshots(df, zone_path(zones.gold, CLV_TABLE), observe=quality.tier_figures(), figures=None if backfill else figures)


def refresh_clv(spark: SparkSession, zones: Zones, snapshots: list, before: DataFrame | None = None) -> dict[str, int]:
    """E3/E6: bring the stored snapshots in line with the current Silver orders, and add those of
    `snapshots` that are missing. What differs from the orders that the stored snapshots were
    computed from (default: the version of Silver before the current one) decides which
    dates are written; the files of all others stay. Returns rows written by date."""
    with released(spark) as scratch:
        table = zone_path(zones.gold, CLV_TABLE)
        if before is None:
            before = read_zone(spark, zones.silver, "s_orders", back=1)
        held = read_zone(spark, zones.gold, CLV_TABLE)
        dates = sorted({*snapshots, *(r[0] for r in held.select("snapshot_date").distinct().collect())})
        found = refresh.refresh(before, read_zone(spark, zones.silver, "s_orders"), held, dates)
        if found is None:
            return {}
        # Written aside first: the rows are made from the table that they replace in part.
        rows = stored(found.rows, "clv-rows")
        drop(spark, scratch[:-1])  # what the rows were made of
        upsert_snapshots(rows, table)
        counts = {r[0]: r[1] for r in rows.groupBy("snapshot_date").agg(F.count(F.lit(1))).collect()}
        for day in found.dates:
            if day not in counts:
                empty_partition(rows, table, "snapshot_date", day)
        return {str(day): counts.get(day, 0) for day in found.dates}


def marts(spark: SparkSession, zones: Zones, analysis_date=None, figures: dict | None = None) -> dict[str, int]:
    """E4: the six marts, each replaced whole. RFM and churn share one per-customer
    aggregate, stored for the duration of the step. `figures` gets the revenue of the sales."""
    sales = "g_fact_sales_trends"
    s = read_silver(spark, zones)
    with released(spark):
        base = stored(mart_ops.customer_base(s["s_orders"], analysis_date), "customer-base")
        built = jobs.build_marts(s, analysis_date, customer_base=base)
        return {name: write_table(df, zone_path(zones.gold, name), observe=quality.sales_figures() if name == sales else (),
                                  figures=figures if name == sales else None) for name, df in built.items()}


def qc_and_publish(spark: SparkSession, zones: Zones, database: str | None = None,
                   expected_items: int | None = None, figures: dict | None = None) -> list[tuple]:
    """E5: quality gates (raise on failure), then register the Gold tables. With the `figures`
    that the steps observed, only the order dates and the calendar are read."""
    s = read_silver(spark, zones)
    known = figures or {}
    if {"items", "expected", "high", "net"} <= known.keys():
        dates = quality.calendar_gaps(s["s_orders"], s["s_date_dim"])
        row = spark.range(1).select(
            *[F.lit(known[c]).cast(kind).alias(c) for c, kind in quality.FIGURES.items() if c != "expected"],
            F.lit(known["expected"] if expected_items is None else expected_items).cast("long").alias("expected"),
            dates.select(F.count(F.lit(1))).scalar().alias("missing_dates"))
        report = quality.gates(row)
    else:
        report = quality.qc_report(s["s_order_items"], s["s_orders"], s["s_date_dim"],
                                   read_zone(spark, zones.gold, CLV_TABLE),
                                   read_zone(spark, zones.gold, "g_fact_sales_trends"),
                                   expected_items=known.get("expected") if expected_items is None else expected_items)
    rows = quality.raise_if_failed(report)
    if database:
        publish_tables(spark, database, zones.gold, GOLD_TABLES, partitioned={CLV_TABLE: "snapshot_date"})
        publish_views(spark, database)
    return rows


def run_daily(spark: SparkSession, sources: dict[str, DataFrame], zones: Zones, batch_date,
              dev_app_name: str, source_label: str = "parquet", database: str | None = None,
              expected_items: int | None = None, run_date=None, analysis_date=None,
              backfill: bool = False) -> dict:
    """E6: the whole chain for one batch date; running it twice equals running it once.
    Silver and Gold are built from the latest Bronze batch. `run_date` and `backfill` go to
    the CLV step, `analysis_date` to the marts."""
    prepare(spark)
    out = {"bronze": ingest(sources, zones, source_label, batch_date)}
    figures: dict = {}
    out["silver"] = silver(spark, zones, dev_app_name, figures=figures)
    # CLV and the marts only read Silver: submit both steps' jobs at once, so the
    # scheduler can interleave their tasks (as the two parallel jobs of the DAG).
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_clv = pool.submit(_in_pool, spark, "clv", clv, spark, zones, run_date, backfill, tiers := {})
        f_marts = pool.submit(_in_pool, spark, "marts", marts, spark, zones, analysis_date, sales := {})
        out["clv"], out["marts"] = f_clv.result(), f_marts.result()
    if tiers:
        figures |= {"customers": tiers["customers"], "high": tiers["high"], "low": tiers["low"]}
    figures |= {"net": sales["net"], "gross": sales["gross"]}
    out["qc"] = qc_and_publish(spark, zones, database, expected_items, figures)
    return out


def _in_pool(spark: SparkSession, pool: str, fn, *args):
    """Run one step's jobs in their own scheduler pool (effective under FAIR mode)."""
    sc = _context(spark)
    if sc is not None:
        sc.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return fn(*args)
    finally:
        if sc is not None:
            sc.setLocalProperty("spark.scheduler.pool", None)
