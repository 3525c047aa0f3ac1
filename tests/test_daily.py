from orderlens.plans import daily
from orderlens.session import scratch_path
from orderlens.sources import fixtures
from orderlens.sources.readers import read_zone


def test_daily_chain_is_idempotent_and_publishes(spark, sf_small):
    zones = daily.Zones.under(scratch_path(spark, "t-daily"))
    sources = {"order_items": fixtures.order_items(spark, sf_small),
               "order_item_options": fixtures.order_item_options(spark, sf_small)}
    first = daily.run_daily(spark, sources, zones, "2024-03-01", fixtures.DEV_APP_NAME,
                            database="t_daily_gold")
    again = daily.run_daily(spark, sources, zones, "2024-03-01", fixtures.DEV_APP_NAME)
    assert first["silver"] == again["silver"] and first["clv"] == again["clv"]
    assert all(passed for _, passed, _ in first["qc"])
    bronze = read_zone(spark, zones.bronze, "b_order_items")
    assert bronze.count() == first["bronze"]["b_order_items"]       # same date: replaced
    clv = read_zone(spark, zones.gold, "g_fact_customer_clv_daily")
    assert clv.count() == first["clv"]
    assert spark.table("t_daily_gold.g_fact_sales_trends").count() == first["marts"]["g_fact_sales_trends"]


def test_reload_of_an_older_date_does_not_roll_back(spark, sf_small):
    zones = daily.Zones.under(scratch_path(spark, "t-reload"))
    sources = {"order_items": fixtures.order_items(spark, sf_small),
               "order_item_options": fixtures.order_item_options(spark, sf_small)}
    older = sources | {"order_items": sources["order_items"].filter("creation_time_utc < '1996'")}
    latest = daily.run_daily(spark, sources, zones, "2024-03-02", fixtures.DEV_APP_NAME)
    again = daily.run_daily(spark, older, zones, "2024-03-01", fixtures.DEV_APP_NAME,
                            run_date="1997-06-30", analysis_date="1997-06-30")
    assert again["bronze"]["b_order_items"] < latest["bronze"]["b_order_items"]
    assert again["silver"] == latest["silver"]
    clv = read_zone(spark, zones.gold, "g_fact_customer_clv_daily")
    days = {str(r[0]) for r in clv.select("snapshot_date").distinct().collect()}
    assert "1997-06-30" in days and len(days) == 2                  # both snapshots are there
