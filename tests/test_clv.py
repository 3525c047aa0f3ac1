import datetime as dt

import pytest

from pyspark.sql import functions as F

from orderlens.operators import clv

ORDERS_SCHEMA = ("order_id string, user_id string, restaurant_id string, is_loyalty boolean, "
                 "is_guest boolean, order_date date, order_net decimal(18,2)")


def orders(spark, rows):
    return spark.createDataFrame(
        [(o, u, "R1", False, u is None, dt.date.fromisoformat(d), __import__("decimal").Decimal(str(n)))
         for o, u, d, n in rows], ORDERS_SCHEMA)


def snaps(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "snapshot_date date")


def test_tiers_and_guest_exclusion(spark):
    o = orders(spark, [("o1", "u1", "2023-01-10", 10), ("o2", "u2", "2023-01-10", 50),
                       ("o3", "u3", "2023-01-10", 100), ("o4", "u4", "2023-01-10", 200),
                       ("o5", "u5", "2023-01-10", 500), ("o6", None, "2023-01-10", 999)])
    for out in (clv.clv_daily(o, "2023-02-01"), clv.clv_as_of(o, snaps(spark, "2023-02-01"))):
        rows = {r.user_id: r for r in out.collect()}
        assert len(rows) == 5 and None not in rows
        assert rows["u5"].clv_tier == "High" and rows["u1"].clv_tier == "Low"
        assert rows["u3"].clv_tier == "Medium"
        assert rows["u1"].recency_days == 22


def test_accumulates_across_snapshots(spark):
    o = orders(spark, [("o1", "u1", "2023-01-01", 10), ("o2", "u1", "2023-02-01", 20)])
    out = sorted(clv.clv_as_of(o, snaps(spark, "2023-01-15", "2023-02-15")).collect(),
                 key=lambda r: r.snapshot_date)
    assert [(r.cum_net_revenue, r.cum_orders) for r in out] == [(10.0, 1), (30.0, 2)]
    assert out[1].first_order_date == dt.date(2023, 1, 1)
    assert out[1].last_order_date == dt.date(2023, 2, 1)


def brute_force(o, s):
    """The reference's statement: every order joined to every later snapshot."""
    j = clv.identified(o).join(F.broadcast(s), F.col("order_date") <= F.col("snapshot_date"))
    return {(r.user_id, r.snapshot_date): (float(r.net), r.n, r.lo, r.hi) for r in
            j.groupBy("user_id", "snapshot_date").agg(
                F.sum("order_net").alias("net"), F.count_distinct("order_id").alias("n"),
                F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).collect()}


def as_map(out):
    return {(r.user_id, r.snapshot_date): (r.cum_net_revenue, r.cum_orders, r.first_order_date,
                                           r.last_order_date) for r in out.collect()}


@pytest.mark.parametrize("method", ["window", "distributed"])
def test_split_order_counted_once(spark, method):
    # one order_id carrying two order dates (lines disagreeing on an attribute)
    o = orders(spark, [("o1", "u1", "2023-01-05", 10), ("o1", "u1", "2023-02-05", 5),
                       ("o2", "u1", "2023-02-06", 7), ("o3", "u2", "2023-03-01", 1)])
    s = snaps(spark, "2023-01-31", "2023-02-28", "2023-03-31")
    got = as_map(clv.clv_as_of(o, s, method=method))
    assert got == brute_force(o, s)
    assert got[("u1", dt.date(2023, 2, 28))][1] == 2


@pytest.mark.parametrize("method", ["window", "distributed"])
def test_matches_range_join_on_driver_data(spark, sf_small, method):
    from orderlens.operators import calendar as cal_ops
    from orderlens.plans.queries import silver

    s = silver(spark, sf_small)
    snaps_df = cal_ops.month_end_snapshots(s["s_date_dim"])
    got = clv.clv_as_of(s["s_orders"], snaps_df, method=method)
    assert as_map(got) == brute_force(s["s_orders"], snaps_df)
    tiers = {(r.user_id, r.snapshot_date): r.clv_tier for r in got.collect()}
    ref = {(r.user_id, r.snapshot_date): r.clv_tier
           for r in clv.clv_as_of(s["s_orders"], snaps_df, method="window").collect()}
    assert tiers == ref


def test_orders_after_last_snapshot_ignored(spark):
    o = orders(spark, [("o1", "u1", "2023-01-05", 10), ("o2", "u1", "2023-05-05", 5)])
    got = as_map(clv.clv_as_of(o, snaps(spark, "2023-01-31")))
    assert got == {("u1", dt.date(2023, 1, 31)): (10.0, 1, dt.date(2023, 1, 5), dt.date(2023, 1, 5))}


def test_aov_half_up(spark):
    o = orders(spark, [("o1", "u1", "2023-01-05", 50.00), ("o2", "u1", "2023-01-06", 50.01)])
    r = clv.clv_daily(o, "2023-01-31").first()
    assert r.avg_order_value == 50.01  # 100.01 / 2 = 50.005 → 50.01
