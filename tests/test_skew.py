"""One customer holding a third of all orders: results stay exact."""
from pyspark.sql import Window, functions as F

from orderlens.operators import calendar as cal_ops
from orderlens.operators import clv, marts


def hot_orders(spark, sf_small):
    from orderlens.plans.queries import silver

    s = silver(spark, sf_small)
    o = s["s_orders"].withColumn(
        "user_id", F.when(F.abs(F.hash("order_id")) % 3 == 0, F.lit("HOT")).otherwise(F.col("user_id")))
    return o, s["s_date_dim"]


def test_hot_customer_clv_and_marts(spark, sf_small):
    o, cal = hot_orders(spark, sf_small)
    ident = o.filter(F.col("user_id").isNotNull())
    share = ident.filter(F.col("user_id") == "HOT").count() / ident.count()
    assert share > 0.3

    snaps = cal_ops.month_end_snapshots(cal)
    fast = clv.clv_as_of(o, snaps, method="distributed")
    naive = clv.identified(o).join(F.broadcast(snaps), F.col("order_date") <= F.col("snapshot_date"))
    naive = (naive.groupBy("user_id", "snapshot_date")
             .agg(F.sum("order_net").cast("double").alias("net"), F.count_distinct("order_id").alias("n")))
    got = {(r.user_id, r.snapshot_date): (r.cum_net_revenue, r.cum_orders) for r in fast.collect()}
    want = {(r.user_id, r.snapshot_date): (r.net, r.n) for r in naive.collect()}
    assert got == want

    d = {(r.user_id): r for r in clv.clv_daily(o, method="distributed").collect()}
    w = {(r.user_id): r for r in clv.clv_daily(o, method="window").collect()}
    assert d == w

    churn = {r.user_id: r for r in marts.build_churn(o).collect()}
    hot_dates = ident.filter(F.col("user_id") == "HOT").select("order_id").distinct().count()
    assert churn["HOT"].orders == hot_dates

    r1 = {r.user_id: (r.r_score, r.f_score, r.m_score) for r in marts.build_rfm(o, method="distributed").collect()}
    r2 = {r.user_id: (r.r_score, r.f_score, r.m_score) for r in marts.build_rfm(o, method="window").collect()}
    assert r1 == r2 and r1["HOT"][1] == 5
