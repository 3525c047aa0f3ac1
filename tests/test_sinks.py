import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.session import scratch_path
from orderlens.sources import readers, sinks


def test_batch_reload_leaves_other_partitions(spark):
    path = scratch_path(spark, "t-batch")
    a = spark.range(5).withColumn("v", F.lit("a"))
    b = spark.range(3).withColumn("v", F.lit("b"))
    assert sinks.write_batch(sinks.stamp_ingest(a, "t", "2024-01-01"), path, "2024-01-01") == 5
    sinks.write_batch(sinks.stamp_ingest(b, "t", "2024-01-02"), path, "2024-01-02")
    sinks.write_batch(sinks.stamp_ingest(a.limit(2), "t", "2024-01-01"), path, "2024-01-01")
    got = {r.batch_date: r.n for r in spark.read.parquet(path).groupBy("batch_date")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {dt.date(2024, 1, 1): 2, dt.date(2024, 1, 2): 3}


def test_dateless_batch_replaces_whole_table(spark):
    path = scratch_path(spark, "t-batch-all")
    a = spark.range(5)
    sinks.write_batch(sinks.stamp_ingest(a, "t", "2024-01-01"), path, "2024-01-01")
    sinks.write_batch(sinks.stamp_ingest(a.limit(1), "t"), path)
    assert spark.read.parquet(path).count() == 1


def test_stamp_types(spark):
    df = sinks.stamp_ingest(spark.range(1), "csv", "2024-02-03")
    types = dict(df.dtypes)
    assert types["batch_date"] == "date" and types["ingest_ts"] == "timestamp"
    assert dict(sinks.stamp_ingest(spark.range(1), "csv").dtypes)["batch_date"] == "date"


def test_snapshot_upsert_replaces_only_its_dates(spark):
    path = scratch_path(spark, "t-snap")
    rows = [("u1", dt.date(2023, 1, 31), 1), ("u1", dt.date(2023, 2, 28), 2)]
    sinks.upsert_snapshots(spark.createDataFrame(rows, "user_id string, snapshot_date date, v int"), path)
    sinks.upsert_snapshots(spark.createDataFrame([("u1", dt.date(2023, 2, 28), 9)],
                                                 "user_id string, snapshot_date date, v int"), path)
    got = {r.snapshot_date: r.v for r in spark.read.parquet(path).collect()}
    assert got == {dt.date(2023, 1, 31): 1, dt.date(2023, 2, 28): 9}


def test_publish_and_registry(spark):
    root = scratch_path(spark, "t-gold")
    sinks.write_table(spark.range(4), f"{root}/g_fact_addon_revenue")
    sinks.publish_tables(spark, "t_gold", root, ["g_fact_addon_revenue"])
    assert spark.table("t_gold.g_fact_addon_revenue").count() == 4
    assert readers.read_gold(spark, root, "g_fact_addon_revenue").count() == 4
    with pytest.raises(KeyError):
        readers.read_gold(spark, root, "not_a_table")


def test_csv_reader_maps_by_name(spark):
    path = scratch_path(spark, "t-csv")
    (spark.createDataFrame([("2", "x", None)], "B string, A string, C string")
     .write.option("header", True).csv(path))
    df = readers.read_csv(spark, path, ["a", "b", "c"])
    assert df.columns == ["a", "b", "c"] and df.first() == ("x", "2", None)


def test_partitioned_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:none", "t", "u", "p", partition_column="id")


def test_publish_partitioned_table(spark):
    root = scratch_path(spark, "t-gold-part")
    rows = [("u1", dt.date(2023, 1, 31), 1), ("u2", dt.date(2023, 2, 28), 2)]
    sinks.upsert_snapshots(spark.createDataFrame(rows, "user_id string, snapshot_date date, v int"),
                           f"{root}/g_fact_customer_clv_daily")
    sinks.publish_tables(spark, "t_gold_p", root, ["g_fact_customer_clv_daily"],
                         partitioned={"g_fact_customer_clv_daily": "snapshot_date"})
    t = spark.table("t_gold_p.g_fact_customer_clv_daily")
    assert t.count() == 2
    latest = t.filter(F.col("snapshot_date") == dt.date(2023, 2, 28))
    assert [r.user_id for r in latest.collect()] == ["u2"]


def test_empty_extract_clears_its_date_and_added_columns_show(spark, tmp_path):
    from orderlens.sources import readers, sinks

    root = str(tmp_path)
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "a int, batch_date string")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.write_batch(rows.filter(rows.batch_date == day), f"{root}/t", day)
    assert sinks.write_batch(rows.filter("false"), f"{root}/t", "2024-01-01") == 0
    assert [r.a for r in readers.read_zone(spark, root, "t").collect()] == [2]
    sinks.write_batch(spark.createDataFrame([(3, 9, "2024-01-03")], "a int, b int, batch_date string"), f"{root}/t", "2024-01-03")
    assert {(r.a, r.b) for r in readers.read_zone(spark, root, "t").collect()} == {(2, None), (3, 9)}
