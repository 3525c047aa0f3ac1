"""Registered round-trip queries for the sources and sinks.

Each one writes tables derived from the driver's data into a fresh folder under the
shared checkpoint root (never a machine-local temp folder), reads them back through
the engine's readers, and returns the result, so the SQL oracle checks what came back.
"""
from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..contracts import GOLD_TABLES, ORDER_ITEM_OPTIONS_COLS
from ..functions.money import money_out
from ..operators import calendar as cal_ops
from ..operators import cleaning, clv, marts
from ..session import application_id, passes, prepare, released, scratch_path, split, stored
from ..sources import fixtures, versions
from ..sources.readers import SourceSpec, read_csv, read_csv_groups, read_gold, read_source, read_zone, zone_path
from ..sources.sinks import (publish_tables, read_published, stamp_ingest, upsert_snapshots,
                             write_batch, write_table)
from . import daily, jobs
from . import oracle as O
from .queries import VIEW_CATEGORIES, VIEW_LOCATIONS, build_silver_tables, oracle_sql, register, silver
from .sql_views import publish_views

# Fixed parameters of the round trips.
BATCH_A = "2024-01-01"
BATCH_B = "2024-01-02"
BATCH_C = "2024-01-03"
#: The refreshed snapshots start from the orders before this day (a first of a month).
REFRESH_FROM = "1997-03-01"
PUBLISH_DB = "orderlens_gold"


def _to_csv(df: DataFrame, path: str, upper: bool = True, compression: str = "none") -> None:
    """Write a raw source as header CSV the way an extract would ship it (UPPERCASE
    names, whitespace kept)."""
    out = df.toDF(*[c.upper() for c in df.columns]) if upper else df
    (out.write.mode("overwrite").option("header", True).option("compression", compression)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def _orders_out(o: DataFrame) -> DataFrame:
    return o.select("order_id", "user_id", "restaurant_id", "is_loyalty", "is_guest",
                    "order_date", money_out("order_net").alias("order_net"))


_ORDERS_SQL = """
SELECT order_id, user_id, restaurant_id, is_loyalty, is_guest, order_date,
       CAST(order_net AS DOUBLE) AS order_net
FROM s_orders"""

_OPTIONS_SQL = """
SELECT order_id, lineitem_id, option_group_name, option_name,
       CAST(option_price AS DOUBLE) AS option_price, option_quantity,
       CAST(option_line AS DOUBLE) AS option_line
FROM s_order_item_options"""


@register("casing", O.with_("x AS (SELECT 1)", select=_OPTIONS_SQL))
def q_casing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPPERCASE CSV headers are lower-cased and mapped by name (columns reordered on
    purpose before writing)."""
    prepare(spark)
    path = scratch_path(spark, "casing")
    raw = fixtures.order_item_options(spark, sf_dir)
    _to_csv(raw.select(*reversed(ORDER_ITEM_OPTIONS_COLS)), path)
    s = cleaning.clean_order_item_options(read_csv(spark, path, ORDER_ITEM_OPTIONS_COLS))
    return s.select("order_id", "lineitem_id", "option_group_name", "option_name",
                    money_out("option_price").alias("option_price"), "option_quantity",
                    money_out("option_line").alias("option_line"))


def _csv_silver(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    prepare(spark)
    root = scratch_path(spark, name)
    _to_csv(fixtures.order_items(spark, sf_dir), f"{root}/order_items")
    _to_csv(fixtures.order_item_options(spark, sf_dir), f"{root}/order_item_options")
    items = read_source(spark, "order_items", SourceSpec("csv", f"{root}/order_items", multiline=True))
    opts = read_source(spark, "order_item_options", SourceSpec("csv", f"{root}/order_item_options"))
    return jobs.build_silver(items, opts, fixtures.DEV_APP_NAME)


@register("csv_scan", O.with_("x AS (SELECT 1)", select=_ORDERS_SQL))
def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources as CSV → Silver orders. Empty and blank user ids survive the CSV
    round trip as NULL / blank and clean to the same guests as the parquet path."""
    return _orders_out(_csv_silver(spark, sf_dir, "csv-scan")["s_orders"])


@register("csv_multiline_scan", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, lineitem_id, user_id, item_name, item_quantity, order_date, is_guest,
       CAST(gross_line AS DOUBLE) AS gross_line
FROM s_order_items"""))
def q_csv_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _csv_silver(spark, sf_dir, "csv-multiline")["s_order_items"]
    return s.select("order_id", "lineitem_id", "user_id", "item_name", "item_quantity",
                    "order_date", "is_guest", money_out("gross_line").alias("gross_line"))


def _mixed_csv(spark: SparkSession, sf_dir: str) -> str:
    """A folder of option extracts: files with the columns in contract order, files with them
    backwards and one more, and files with lines of two and of eight fields."""
    prepare(spark)
    root = scratch_path(spark, "csv-mixed")
    raw = fixtures.order_item_options(spark, sf_dir)
    half = F.crc32("order_id") % 2
    _to_csv(raw.filter(half == 0), f"{root}/a")
    _to_csv(raw.filter(half == 1).select(F.lit("x").alias("extra"), *reversed(ORDER_ITEM_OPTIONS_COLS)), f"{root}/b")
    broken = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_orderkey % 50 = 0")
    key = F.concat_ws(",", "l_orderkey", "l_linenumber")
    lines = broken.select(F.when(F.col("l_linenumber") == 1, F.concat(key, F.lit(",a,b,c,d,e,f"))).otherwise(key)
                          .alias(",".join(ORDER_ITEM_OPTIONS_COLS).upper()))
    lines.write.option("header", True).option("sep", "|").option("quote", "\0").option("escapeQuotes", False).csv(f"{root}/c")
    return f"{root}/*"


@register("csv_header_groups", O.with_("x AS (SELECT 1)", select=_OPTIONS_SQL))
def q_csv_header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with different headers, read by their own and united by name."""
    s = cleaning.clean_order_item_options(read_csv_groups(spark, _mixed_csv(spark, sf_dir), ORDER_ITEM_OPTIONS_COLS).rows)
    return s.select("order_id", "lineitem_id", "option_group_name", "option_name",
                    money_out("option_price").alias("option_price"), "option_quantity",
                    money_out("option_line").alias("option_line"))


@register("csv_rejects", """
SELECT CASE WHEN l_linenumber = 1 THEN 'too many fields' ELSE 'too few fields' END AS reason,
       count(*) AS lines, min(concat(l_orderkey, ',', l_linenumber, CASE WHEN l_linenumber = 1 THEN ',a,b,c,d,e,f' ELSE '' END)) AS first_line
FROM lineitem WHERE l_orderkey % 50 = 0 GROUP BY 1""")
def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no rows, by reason."""
    rejects = read_csv_groups(spark, _mixed_csv(spark, sf_dir), ORDER_ITEM_OPTIONS_COLS).rejects
    return rejects.groupBy("reason").agg(F.count("file").alias("lines"), F.min("line").alias("first_line"))


@register("bronze_stamp", O.with_("x AS (SELECT 1)", select=f"""
SELECT *, 'parquet' AS source, DATE '{BATCH_A}' AS batch_date FROM src_order_items"""))
def q_bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    stamped = stamp_ingest(fixtures.order_items(spark, sf_dir), "parquet", BATCH_A)
    return stamped.drop("ingest_ts")  # clock-dependent


@register("batch_overwrite", O.with_("x AS (SELECT 1)", select=f"""
SELECT DATE '{BATCH_A}' AS batch_date, count(*) AS rows FROM src_order_items
UNION ALL SELECT DATE '{BATCH_B}', count(*) FROM src_order_items"""))
def q_batch_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land batch A, batch B, then A again: A is replaced, B untouched, nothing doubles. A
    batch of a later date lands and is reloaded empty: it has no rows left."""
    prepare(spark)
    path = scratch_path(spark, "batch-overwrite")
    src = stored(fixtures.order_items(spark, sf_dir), "batch-extract")  # landed four times: joined once
    for bd in (BATCH_A, BATCH_B, BATCH_A, BATCH_C):
        write_batch(stamp_ingest(src, "parquet", bd), path, bd)
    write_batch(stamp_ingest(src.filter("false"), "parquet", BATCH_C), path, BATCH_C)
    back = spark.read.parquet(path)
    return back.groupBy("batch_date").agg(F.count(F.lit(1)).alias("rows"))


@register("zone_overwrite", O.with_("x AS (SELECT 1)", select=_ORDERS_SQL))
def q_zone_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-table overwrite twice, then read by zone and name."""
    root = scratch_path(spark, "zone")
    o = silver(spark, sf_dir)["s_orders"]
    write_table(o, zone_path(root, "s_orders"))
    write_table(o, zone_path(root, "s_orders"))
    return _orders_out(read_zone(spark, root, "s_orders"))


@register("snapshot_upsert", O.with_(O.CLV_MONTH_END, select="SELECT * FROM clv"))
def q_snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end backfill, then the daily run for the last order date: the daily run
    replaces its one snapshot partition and leaves the other dates as they were."""
    s = silver(spark, sf_dir)
    path = scratch_path(spark, "clv-upsert")
    upsert_snapshots(clv.clv_as_of(s["s_orders"], cal_ops.month_end_snapshots(s["s_date_dim"])), path)
    upsert_snapshots(clv.clv_daily(s["s_orders"]), path)
    return spark.read.parquet(path).select(*clv.CLV_COLUMNS)


@register("write_row_counts", O.with_("x AS (SELECT 1)", select="""
SELECT 's_order_items' AS table_name, count(*) AS rows FROM s_order_items
UNION ALL SELECT 's_order_item_options', count(*) FROM s_order_item_options
UNION ALL SELECT 's_date_dim', count(*) FROM s_date_dim
UNION ALL SELECT 's_order_lines', count(*) FROM s_order_lines
UNION ALL SELECT 's_orders', count(*) FROM s_orders"""))
def q_write_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per Silver table, observed during the writes (no recount)."""
    prepare(spark)
    zones = daily.Zones.under(scratch_path(spark, "counts"))
    daily.ingest({"order_items": fixtures.order_items(spark, sf_dir),
                  "order_item_options": fixtures.order_item_options(spark, sf_dir)},
                 zones, "parquet", BATCH_A)
    counts = daily.silver(spark, zones, fixtures.DEV_APP_NAME)
    return spark.createDataFrame(sorted(counts.items()), "table_name string, rows long")


@register("publish_catalog", O.with_(O.LOCATION, select="SELECT * FROM location"))
def q_publish_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a mart, register it in the catalog, read it back by table name."""
    root = scratch_path(spark, "publish")
    loc = marts.build_location_performance(silver(spark, sf_dir)["s_orders"])
    write_table(loc, zone_path(root, "g_fact_location_performance"))
    publish_tables(spark, PUBLISH_DB, root, ["g_fact_location_performance"])
    return spark.table(f"{PUBLISH_DB}.g_fact_location_performance")


@register("publish_partitions", O.with_(O.CLV_MONTH_END, select="""
SELECT * FROM clv WHERE snapshot_date <> (SELECT min(snapshot_date) FROM clv)"""))
def q_publish_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end CLV published by date. Another session then writes the last date, which the
    publisher left out, and removes the first: reading by table name shows both changes."""
    s = silver(spark, sf_dir)
    root = scratch_path(spark, "publish-partitions")
    path = zone_path(root, daily.CLV_TABLE)
    rows = stored(clv.clv_as_of(s["s_orders"], cal_ops.month_end_snapshots(s["s_date_dim"])), "clv-rows")
    ends = F.col("snapshot_date") == rows.select(F.max("snapshot_date")).scalar()
    upsert_snapshots(rows.filter(~ends), path)
    publish_tables(spark, PUBLISH_DB, root, [daily.CLV_TABLE], partitioned={daily.CLV_TABLE: "snapshot_date"})
    upsert_snapshots(rows.filter(ends), path)
    first = rows.agg(F.min("snapshot_date")).first()[0]
    versions.Folder(spark.newSession(), path).delete(f"snapshot_date={first}")
    return read_published(spark, PUBLISH_DB, daily.CLV_TABLE).select(*clv.CLV_COLUMNS)


def _refreshed(spark: SparkSession, sf_dir: str, name: str, before: DataFrame, known: Column) -> DataFrame:
    """The CLV table computed from `before` at the `known` month ends, refreshed to the orders of
    Silver and all month ends."""
    s = silver(spark, sf_dir)
    zones = daily.Zones.under(scratch_path(spark, name))
    ends = cal_ops.month_end_snapshots(s["s_date_dim"])
    with released(spark):
        upsert_snapshots(clv.clv_as_of(before, ends.filter(known)), zone_path(zones.gold, daily.CLV_TABLE))
    write_table(before, zone_path(zones.silver, "s_orders"))
    write_table(s["s_orders"], zone_path(zones.silver, "s_orders"))
    daily.refresh_clv(spark, zones, [r[0] for r in ends.collect()])  # one row a month
    return read_zone(spark, zones.gold, daily.CLV_TABLE).select(*clv.CLV_COLUMNS)


@register("clv_refresh_append", O.with_(O.CLV_MONTH_END, select="SELECT * FROM clv"))
def q_clv_refresh_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of the orders before a day, brought up to all orders: equal to a full run."""
    before = silver(spark, sf_dir)["s_orders"].filter(F.col("order_date") < REFRESH_FROM)
    return _refreshed(spark, sf_dir, "refresh-append", before, F.col("snapshot_date") < REFRESH_FROM)


@register("clv_refresh_correction", O.with_(O.CLV_MONTH_END, select="SELECT * FROM clv"))
def q_clv_refresh_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch before had other amounts, customers and days for some orders, lacked some and
    had some twice; only snapshots from the first such day on are written again."""
    o = silver(spark, sf_dir)["s_orders"]
    k = F.crc32("order_id") % 500
    late = F.col("order_date") >= "1995-06-01"
    wrong = o.filter(~(late & (k == 0))).withColumns({
        "order_net": F.when(late & (k == 1), F.col("order_net") + 5).otherwise(F.col("order_net")).cast("decimal(18,2)"),
        "user_id": F.when(late & (k == 2), F.lit("1")).otherwise(F.col("user_id")),
        "order_date": F.when(late & (k == 3), F.date_sub("order_date", 40)).otherwise(F.col("order_date"))})
    return _refreshed(spark, sf_dir, "refresh-correction", wrong.unionByName(o.filter(late & (k == 4))), F.col("snapshot_date") < "1998-06-01")


@register("gold_read", O.with_(O.LOYALTY, select="SELECT * FROM loyalty"))
def q_gold_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart replaced twice, read by its registered name; the first version is another's."""
    s = silver(spark, sf_dir)
    root = scratch_path(spark, "gold-read")
    name = "g_fact_loyalty_impact"
    for orders in (s["s_orders"].filter("is_loyalty"), s["s_orders"]):
        write_table(marts.build_loyalty_impact(orders), zone_path(root, name))
    return read_gold(spark, root, name)


@register("daily_reload", O.with_("x AS (SELECT 1)", select=_ORDERS_SQL))
def q_daily_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older extract lands for date A, the whole daily chain runs for date B (QC gates
    included), then both dates are landed again, A last, and Silver is rebuilt: its orders
    equal those of a single run for B."""
    prepare(spark)
    zones = daily.Zones.under(scratch_path(spark, "daily"))
    sources = {"order_items": fixtures.order_items(spark, sf_dir),
               "order_item_options": fixtures.order_item_options(spark, sf_dir)}
    older = sources | {"order_items": sources["order_items"].filter(F.col("creation_time_utc") < "1996")}
    daily.ingest(older, zones, "parquet", BATCH_A)
    daily.run_daily(spark, sources, zones, BATCH_B, fixtures.DEV_APP_NAME)
    daily.ingest(sources, zones, "parquet", BATCH_B)
    daily.ingest(older, zones, "parquet", BATCH_A)
    daily.silver(spark, zones, fixtures.DEV_APP_NAME)
    return _orders_out(read_zone(spark, zones.silver, "s_orders"))


@register("landing_stream_ingest", O.with_("x AS (SELECT 1)", select=_ORDERS_SQL))
def q_landing_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract lands in two increments on two dates, each followed by two streaming
    ingest runs (the second finds no new file and lands nothing); Silver orders built from
    Bronze equal the direct path's."""
    from ..streaming.landing import ingest_landing

    prepare(spark)
    root = scratch_path(spark, "landing")
    zones = daily.Zones.under(root)
    half = F.crc32("order_id") % 2
    for part, batch_date in enumerate((BATCH_A, BATCH_B)):
        for table, source, multiline in (("order_items", fixtures.order_items, True),
                                         ("order_item_options", fixtures.order_item_options, False)):
            _to_csv(source(spark, sf_dir).filter(half == part), f"{root}/landing/{table}/part={part}", compression="gzip")
            for _ in range(2):
                ingest_landing(spark, f"{root}/landing/{table}/*", table,
                               zone_path(zones.bronze, f"b_{table}"), f"{root}/_stream/{table}",
                               batch_date=batch_date, multiline=multiline)
    items, options = (daily.read_bronze_batch(spark, zones, t) for t in ("order_items", "order_item_options"))
    # No order is in two parts: as in Silver, those of a large Bronze are built part after part.
    n = passes(items, options)
    orders = [jobs.build_silver(*part, fixtures.DEV_APP_NAME)["s_orders"]
              for part in zip(split(items, n, "order_id"), split(options, n, "order_id"))]
    return _orders_out(orders[0] if n == 1 else reduce(DataFrame.unionByName, [stored(o, "landing-orders") for o in orders]))


# ------------------------------------------------------------------ views by plain SQL
# Gold written and published once per (application, data folder).
_PUBLISHED_GOLD: dict[tuple[str, str], str] = {}


def published_gold(spark: SparkSession, sf_dir: str) -> str:
    """The database of the Gold tables made from `sf_dir`."""
    key = (application_id(spark), os.path.abspath(sf_dir))
    if key not in _PUBLISHED_GOLD:
        zones = daily.Zones("", build_silver_tables(spark, sf_dir), scratch_path(spark, "gold"))
        daily.clv(spark, zones)
        daily.marts(spark, zones)
        database = f"orderlens_{zones.gold.rsplit('-', 1)[-1][:12]}"
        publish_tables(spark, database, zones.gold, GOLD_TABLES, partitioned={daily.CLV_TABLE: "snapshot_date"})
        _PUBLISHED_GOLD[key] = database
    return _PUBLISHED_GOLD[key]


_CATEGORIES, _LOCATIONS = ("array(" + ", ".join(f"'{v}'" for v in values) + ")" for values in (VIEW_CATEGORIES, VIEW_LOCATIONS))
#: Registered name: (view and arguments, the query whose oracle says the same).
SQL_VIEWS = {
    "sql_clv_overview": ("v_clv_overview()", "clv_overview_kpis"),
    "sql_clv_tiers": ("v_clv_tiers()", "clv_tier_split"),
    "sql_top_customers": ("v_top_customers()", "top_customers"),
    "sql_rfm_segments": ("v_rfm_segments()", "rfm_segments"),
    "sql_rfm_score_mix": ("v_rfm_score_mix()", "rfm_score_mix"),
    "sql_at_risk_share": ("v_at_risk_share(60)", "at_risk_share"),
    "sql_churn_histogram": ("v_churn_histogram()", "churn_histogram"),
    "sql_at_risk_customers": ("v_at_risk_customers()", "at_risk_customers"),
    "sql_sales_filtered": (f"v_sales({_CATEGORIES}, {_LOCATIONS})", "sales_filtered"),
    "sql_sales_monthly": ("v_sales_monthly()", "sales_monthly"),
    "sql_sales_monthly_filtered": (f"v_sales_monthly({_CATEGORIES}, {_LOCATIONS})", "sales_monthly_filtered"),
    "sql_sales_kpis": ("v_sales_kpis()", "sales_kpis"),
    "sql_top_categories": ("v_top_categories()", "top_categories"),
    "sql_loyalty_cohorts": ("v_loyalty_cohorts()", "loyalty_cohorts"),
    "sql_location_kpis": ("v_location_kpis()", "location_kpis"),
    "sql_addon_kpis": ("v_addon_kpis()", "addon_kpis"),
    "sql_filter_values": ("v_filter_values()", "filter_values"),
}


def _register_sql_view(name: str, call: str, like: str) -> None:
    @register(name, oracle_sql()[like])
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        publish_views(spark, published_gold(spark, sf_dir), temporary=True)
        return spark.sql(f"SELECT * FROM {call}")


for _name, (_call, _like) in SQL_VIEWS.items():
    _register_sql_view(_name, _call, _like)
