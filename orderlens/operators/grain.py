"""Conformed line and order grain.

net_line = gross_line + Σ(option lines of that line). Options are summed per
(order_id, lineitem_id) before the join (eager aggregation), so the join sees at most
one option row per line.

Layout is left to the planner on purpose: forcing both sides onto `order_id` would save
one exchange but would send a hot order (or a large group of duplicate option rows) to a
single task. With the default plan the option dedup and sums combine map-side, the join
exchange is one AQE can split when a partition is skewed, and the order aggregate
combines map-side before its shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.money import MONEY, money_sum

ORDER_KEYS = ["order_id", "user_id", "restaurant_id", "is_loyalty", "is_guest", "order_date"]


def option_totals(s_options: DataFrame) -> DataFrame:
    return (s_options.groupBy("order_id", "lineitem_id")
            .agg(money_sum("option_line").alias("opt_revenue")))


def build_order_lines(s_items: DataFrame, s_options: DataFrame) -> DataFrame:
    opt = option_totals(s_options)
    j = s_items.join(opt, ["order_id", "lineitem_id"], "left")
    opt_rev = F.coalesce(F.col("opt_revenue"), F.lit(0).cast(MONEY))
    return j.withColumns({
        "opt_revenue": opt_rev,
        "net_line": (F.col("gross_line") + opt_rev).cast(MONEY),
    })


def build_orders(s_order_lines: DataFrame) -> DataFrame:
    """One row per (order_id, user_id, restaurant_id, is_loyalty, is_guest, order_date);
    an order whose lines disagree on an attribute yields one row per variant."""
    return (s_order_lines.groupBy(*ORDER_KEYS)
            .agg(money_sum("net_line").alias("order_net")))
