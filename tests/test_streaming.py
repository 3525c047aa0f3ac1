from orderlens.contracts import ORDER_ITEM_OPTIONS_COLS
from orderlens.plans.daily import Zones, read_bronze_batch
from orderlens.session import scratch_path
from orderlens.streaming.landing import ingest_landing


def drop(spark, path, rows):
    (spark.createDataFrame(rows, [c.upper() for c in ORDER_ITEM_OPTIONS_COLS])
     .coalesce(1).write.mode("append").option("header", True).csv(path))


def test_each_landed_file_is_ingested_once(spark):
    root = scratch_path(spark, "t-stream")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/ckpt"
    drop(spark, landing, [("O1", "L1", "G", "A", "0.50", "1"), ("O2", "L1", "G", "B", "0.25", "2")])
    ingest_landing(spark, landing, "order_item_options", bronze, ckpt, batch_date="2024-01-01")
    assert spark.read.parquet(bronze).count() == 2
    ingest_landing(spark, landing, "order_item_options", bronze, ckpt, batch_date="2024-01-01")
    assert spark.read.parquet(bronze).count() == 2          # nothing new: nothing landed
    drop(spark, landing, [("O3", "L2", "G", "C", "1.00", "1")])
    ingest_landing(spark, landing, "order_item_options", bronze, ckpt, batch_date="2024-01-02")
    back = spark.read.parquet(bronze)
    assert sorted(r.order_id for r in back.collect()) == ["O1", "O2", "O3"]
    assert set(back.columns) >= set(ORDER_ITEM_OPTIONS_COLS) | {"batch_date", "stream_batch", "ingest_ts"}
    zones = Zones(root, f"{root}/silver", f"{root}/gold")
    back.write.partitionBy("stream_batch", "batch_date").parquet(f"{root}/b_order_item_options")
    assert read_bronze_batch(spark, zones, "order_item_options").count() == 3   # increments of both dates
    assert read_bronze_batch(spark, zones, "order_item_options", "2024-01-01").count() == 2


def test_a_batch_retried_on_a_later_date_lands_once(spark):
    root = scratch_path(spark, "t-stream-retry")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    drop(spark, landing, [("O1", "L1", "G", "A", "0.50", "1")])
    # A new checkpoint folder stands for a commit that was lost: batch 0 runs again.
    for k, day in enumerate(("2024-01-01", "2024-01-02")):
        ingest_landing(spark, landing, "order_item_options", bronze, f"{root}/ckpt{k}", batch_date=day)
    assert [str(r.batch_date) for r in spark.read.parquet(bronze).collect()] == ["2024-01-02"]
