"""Customer lifetime value snapshots (grain user_id × snapshot_date).

For each snapshot date and each identified customer with an order on or before it:
cumulative net revenue, distinct orders, first/last order date, recency, average order
value, and a High/Medium/Low tier from NTILE(5) of cumulative revenue within the
snapshot (5 → High, 1 → Low, else Medium; ties broken by user_id).

Many snapshots (`clv_as_of`) are computed without a range join: joining orders to every
later snapshot multiplies the orders by the number of snapshots. Instead each order is
mapped to the first snapshot on or after its date (an equi-join against a date → bucket
map whose size is the number of days spanned), aggregated once per (user, bucket), and
carried forward with a running window per user. The window sees at most one row per
(user, bucket), so even a customer with a huge share of all orders is a few hundred rows
there. Work grows with orders + users × snapshots, not orders × snapshots. Tiers come from
cut points (`cutpoints`), so no snapshot is sorted or gathered.

Broadcasts: the date → bucket map has one row a day up to the last snapshot, at most the 3.65
million days that a date can name; the snapshots are fewer.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import MONEY, cents, half_up_ratio, money_out, money_sum
from ..session import stored
from . import cutpoints

# Tier labels by quintile (5 = top 20 %, 1 = bottom 20 %).
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "High", "Medium", "Low"
TIERS = 5

CLV_COLUMNS = ["user_id", "snapshot_date", "cum_net_revenue", "cum_orders",
               "first_order_date", "last_order_date", "recency_days",
               "avg_order_value", "clv_tier"]


def identified(orders: DataFrame) -> DataFrame:
    """Guests (NULL user_id) are out of every customer-level figure."""
    return orders.filter(F.col("user_id").isNotNull())


def finish(state: DataFrame, method: str = "distributed", with_tiers: bool = True, group: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """state(user_id, snapshot_date, cum_net MONEY, cum_orders, first, last) → CLV rows.
    `with_tiers=False` skips the ranking for callers that never read `clv_tier`; `group` is
    empty for one snapshot. method="window" is Spark's window function, for comparison."""
    state = state.withColumns({
        "recency_days": F.datediff("snapshot_date", "last_order_date"),
        "avg_order_value": half_up_ratio(cents("cum_net_revenue"), F.col("cum_orders"), 2, 2),
    })
    if not with_tiers:
        return state.select(
            "user_id", "snapshot_date", money_out("cum_net_revenue").alias("cum_net_revenue"),
            "cum_orders", "first_order_date", "last_order_date", "recency_days",
            "avg_order_value", F.lit(None).cast("string").alias("clv_tier"))
    if method == "window":
        w = Window.partitionBy("snapshot_date").orderBy("cum_net_revenue", "user_id")
        tiered = state.withColumn("_tile", F.ntile(TIERS).over(w))
    else:
        tiered = cutpoints.ntile(state, TIERS, cents("cum_net_revenue"), "user_id", group, "_tile")  # passes over `state`
    tier = (F.when(F.col("_tile") == TIERS, F.lit(TIER_HIGH))
            .when(F.col("_tile") == 1, F.lit(TIER_LOW))
            .otherwise(F.lit(TIER_MEDIUM)))
    return tiered.select(
        "user_id", "snapshot_date", money_out("cum_net_revenue").alias("cum_net_revenue"),
        "cum_orders", "first_order_date", "last_order_date", "recency_days",
        "avg_order_value", tier.alias("clv_tier"))


def clv_daily(orders: DataFrame, run_date: str | _dt.date | Column | None = None,
              method: str = "distributed", with_tiers: bool = True) -> DataFrame:
    """One snapshot. `run_date` defaults to the last order date (computed in-plan as a
    scalar subquery, not collected)."""
    o = identified(orders)
    if run_date is None:
        snap = orders.select(F.max("order_date")).scalar()
    elif isinstance(run_date, Column):
        snap = run_date
    else:
        snap = F.lit(str(run_date)).cast("date")
    o = o.filter(F.col("order_date") <= snap)
    state = (o.groupBy("user_id")
             .agg(money_sum("order_net").alias("cum_net_revenue"),
                  F.count_distinct("order_id").alias("cum_orders"),
                  F.min("order_date").alias("first_order_date"),
                  F.max("order_date").alias("last_order_date"))
             .withColumn("snapshot_date", snap))
    if with_tiers and method != "window":
        state = stored(state, "clv-state")
    return finish(state, method, with_tiers, group=())


def snapshot_buckets(snapshots: DataFrame, lo: Column) -> DataFrame:
    """snapshots(snapshot_date) → (date_key, bidx, n_snap): every day from `lo` up to
    the last snapshot, with the index of the first snapshot on or after it. Size = days
    spanned, so it is safe to broadcast."""
    s = snapshots.select("snapshot_date").distinct()
    w = Window.orderBy("snapshot_date")  # one row per snapshot date: a small table
    s = s.select("snapshot_date",
                 F.row_number().over(w).alias("bidx"),
                 F.lag("snapshot_date").over(w).alias("_prev"),
                 F.count(F.lit(1)).over(Window.partitionBy()).alias("n_snap"))
    start = F.coalesce(F.date_add("_prev", 1), F.least(lo, F.col("snapshot_date")))
    return (s.select(F.explode(F.sequence(start, F.col("snapshot_date"))).alias("date_key"),
                    "bidx", "n_snap"))


def clv_as_of(orders: DataFrame, snapshots: DataFrame, method: str = "distributed",
              with_tiers: bool = True, start: DataFrame | None = None) -> DataFrame:
    """CLV at every date in `snapshots(snapshot_date)`. `start`(user_id, net, cum_orders,
    first_order_date, last_order_date) are what customers had before `orders`: it counts from
    the first snapshot on."""
    o = identified(orders)
    lo = orders.select(F.min("order_date")).scalar()
    buckets = snapshot_buckets(snapshots, lo)
    snap_idx = snapshots.select("snapshot_date").distinct().select(
        "snapshot_date", F.row_number().over(Window.orderBy("snapshot_date")).alias("sidx"))

    # Orders after the last snapshot (or with no date) fall out of the inner join;
    # broadcasting the map keeps a hot order date from landing in one shuffle partition.
    ob = (o.join(F.broadcast(buckets), o.order_date == buckets.date_key)
          .select("user_id", "order_id", "bidx", "n_snap", "order_net", "order_date"))
    # A distinct order counts from the first bucket it appears in (an order whose rows carry
    # different dates must not be counted twice): it adds one there, beside its rows, which
    # add their money. One aggregate takes both, combined map-side, so even a hot customer's
    # rows are reduced before the shuffle, and nothing is joined again.
    counted = ob.filter(F.col("order_id").isNotNull()).groupBy("user_id", "order_id").agg(F.min("bidx").alias("bidx"))
    rows = ob.select("user_id", "bidx", "n_snap", "order_net", F.col("order_date").alias("first_d"),
                     F.col("order_date").alias("last_d"), F.lit(0).cast("long").alias("new"))
    rows = rows.unionByName(counted.select("user_id", "bidx", F.lit(1).cast("long").alias("new")), allowMissingColumns=True)
    if start is not None:
        n_snap = snap_idx.select(F.max("sidx")).scalar()
        rows = rows.unionByName(start.select(
            "user_id", F.lit(1).alias("bidx"), n_snap.alias("n_snap"), F.col("net").alias("order_net"),
            F.col("first_order_date").alias("first_d"), F.col("last_order_date").alias("last_d"), F.col("cum_orders").alias("new")))
    b = (rows.groupBy("user_id", "bidx")
         .agg(money_sum("order_net").alias("net"), F.sum("new").alias("new_orders"), F.min("first_d").alias("first_d"),
              F.max("last_d").alias("last_d"), F.max("n_snap").alias("n_snap")))

    w = Window.partitionBy("user_id").orderBy("bidx")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = b.select(
        "user_id", "bidx", "n_snap",
        F.sum("net").over(upto).cast(MONEY).alias("cum_net_revenue"),
        F.sum("new_orders").over(upto).alias("cum_orders"),
        F.min("first_d").over(upto).alias("first_order_date"),
        F.max("last_d").over(upto).alias("last_order_date"),
        F.lead("bidx").over(w).alias("_next"))
    if with_tiers and method != "window":
        cum = stored(cum, "clv-cumulative")
    # Carry each state forward to every snapshot before the user's next active bucket.
    dense = cum.withColumn("sidx", F.explode(F.sequence(
        F.col("bidx"), F.coalesce(F.col("_next") - 1, F.col("n_snap")).cast("int"))))
    state = dense.join(F.broadcast(snap_idx), "sidx").drop("sidx", "bidx", "_next", "n_snap")
    return finish(state, method, with_tiers)
