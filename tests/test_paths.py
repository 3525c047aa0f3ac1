import datetime as dt

from pyspark.sql import functions as F

from orderlens.contracts import ORDER_ITEM_OPTIONS_COLS
from orderlens.operators import clv, views
from orderlens.plans import daily, jobs
from orderlens.session import scratch_path
from orderlens.sources import fixtures, readers, sinks


def test_parquet_source_mode_lowercases_and_projects(spark):
    path = scratch_path(spark, "t-pq")
    cols = [c.upper() for c in ORDER_ITEM_OPTIONS_COLS] + ["EXTRA"]
    spark.createDataFrame([("O1", "L1", "G", "A", "0.5", "1", "x")], cols).write.parquet(path)
    df = readers.read_source(spark, "order_item_options", readers.SourceSpec("parquet", path))
    assert df.columns == ORDER_ITEM_OPTIONS_COLS


def test_backfill_job_writes_month_end_snapshots(spark, sf_small):
    zones = daily.Zones.under(scratch_path(spark, "t-backfill"))
    daily.write_silver(spark, fixtures.order_items(spark, sf_small),
                       fixtures.order_item_options(spark, sf_small), fixtures.DEV_APP_NAME, zones.silver)
    rows = daily.clv(spark, zones, backfill=True)
    back = spark.read.parquet(f"{zones.gold}/{daily.CLV_TABLE}")
    assert back.count() == rows
    s = daily.read_silver(spark, zones)
    n_snaps = jobs.cal_ops.month_end_snapshots(s["s_date_dim"]).count()
    assert back.select("snapshot_date").distinct().count() == n_snaps
    # the daily run for the last order date equals the last month-end snapshot
    last = back.agg(F.max("snapshot_date")).first()[0]
    daily_rows = {tuple(r) for r in clv.clv_daily(s["s_orders"]).collect()}
    month_rows = {tuple(r) for r in back.filter(F.col("snapshot_date") == last)
                  .select(*clv.CLV_COLUMNS).collect()}
    assert daily_rows == month_rows


def test_run_date_as_column_and_literal_agree(spark):
    o = spark.createDataFrame(
        [("o1", "u1", "R1", False, False, dt.date(2023, 1, 5), 10),
         ("o2", "u1", "R1", False, False, dt.date(2023, 3, 5), 5)],
        "order_id string, user_id string, restaurant_id string, is_loyalty boolean, "
        "is_guest boolean, order_date date, order_net int").withColumn(
        "order_net", F.col("order_net").cast("decimal(18,2)"))
    a = clv.clv_daily(o, "2023-02-01").collect()
    b = clv.clv_daily(o, F.lit("2023-02-01").cast("date")).collect()
    assert a == b and a[0].cum_orders == 1


def test_empty_filters_mean_no_filter(spark):
    sales = spark.createDataFrame([("A", "R1"), ("B", "R2")], "item_category string, restaurant_id string")
    assert views.filter_sales(sales).count() == 2
    assert views.filter_sales(sales, ["A"]).count() == 1
    assert views.filter_sales(sales, [], ["R2"]).count() == 1
