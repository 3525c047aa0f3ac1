"""Analytical views over the Gold marts, as Spark queries.

Each view answers one dashboard question directly on the marts, so nothing is pulled
into a single process to be filtered or aggregated there. Published money columns are
DOUBLE; views turn them back into exact DECIMAL(18,2) (the cast recovers the cents
exactly) before summing, so totals do not depend on the order of addition.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import MONEY, cents, half_up_ratio, money_out
from .clv import TIER_HIGH, TIER_LOW, TIER_MEDIUM

# Fixed values.
TOP_CUSTOMERS = 15
TOP_CATEGORIES = 15
AT_RISK_LIST = 200
DEFAULT_AT_RISK_THRESHOLD = 45
# Days-since-last-order histogram: (label, lower exclusive, upper inclusive).
CHURN_BINS = [("0-15", 0, 15), ("16-30", 15, 30), ("31-45", 30, 45), ("46-60", 45, 60),
              ("61-90", 60, 90), ("91-180", 90, 180), ("180+", 180, 10000)]
TIER_ORDER = [TIER_HIGH, TIER_MEDIUM, TIER_LOW]
LOYALTY_LABEL, NON_LOYALTY_LABEL = "Loyalty", "Non-loyalty"


def as_money(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def latest_snapshot(clv: DataFrame) -> DataFrame:
    """Rows of the latest snapshot (scalar subquery; a snapshot-partitioned table is
    pruned to one partition)."""
    return clv.filter(F.col("snapshot_date") == clv.select(F.max("snapshot_date")).scalar())


def clv_overview_kpis(clv: DataFrame, sales_trends: DataFrame) -> DataFrame:
    snap = latest_snapshot(clv)
    total_net_all = sales_trends.select(F.sum(as_money("net_revenue")).cast(MONEY)).scalar()
    g = snap.agg(F.max("snapshot_date").alias("snapshot_date"),
                 F.count_distinct("user_id").alias("identified_customers"),
                 F.sum(as_money("cum_net_revenue")).cast(MONEY).alias("_total"),
                 F.count("cum_net_revenue").alias("_n"),
                 F.sum("cum_orders").alias("_orders"),
                 F.count("cum_orders").alias("_orders_n"))
    return g.select("snapshot_date", "identified_customers",
                    money_out("_total").alias("total_clv"),
                    money_out(total_net_all).alias("total_net_revenue_all"),
                    half_up_ratio(cents("_total"), F.col("_n"), 2, 2).alias("avg_clv"),
                    half_up_ratio(F.col("_orders"), F.col("_orders_n"), 2).alias("avg_orders"))


def _label_table(spark, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def clv_tier_split(clv: DataFrame) -> DataFrame:
    """Customers per tier at the latest snapshot, always three rows (High, Medium, Low)."""
    snap = latest_snapshot(clv)
    counts = snap.groupBy("clv_tier").agg(F.count(F.lit(1)).alias("_c"))
    tiers = _label_table(clv.sparkSession, [(t, i + 1) for i, t in enumerate(TIER_ORDER)],
                         "clv_tier string, tier_order int")
    j = tiers.join(counts, "clv_tier", "left")
    customers = F.coalesce(F.col("_c"), F.lit(0).cast("long"))
    total = F.sum(customers).over(Window.partitionBy())  # three rows
    return j.select("clv_tier", "tier_order", customers.alias("customers"),
                    F.try_divide(customers, total).alias("share"))


def top_customers(clv: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    snap = latest_snapshot(clv)
    return (snap.orderBy(F.col("cum_net_revenue").desc(), F.col("user_id").asc()).limit(k)
            .select("user_id", "cum_net_revenue", "cum_orders", "avg_order_value",
                    "recency_days", "clv_tier"))


def rfm_segments(rfm: DataFrame) -> DataFrame:
    return (rfm.groupBy("rfm_segment").agg(F.count("user_id").alias("customers"))
            .orderBy(F.desc("customers"), "rfm_segment"))


def rfm_score_mix(rfm: DataFrame) -> DataFrame:
    """Customers per score value (1–5) for each of R, F, M; 0 where none."""
    scores = ["r_score", "f_score", "m_score"]
    long = rfm.unpivot("user_id", scores, "score", "value")
    return (long.groupBy("value").pivot("score", scores).count().na.fill(0, subset=scores)
            .select("value", *scores))


def at_risk_share(churn: DataFrame, threshold: int = 60) -> DataFrame:
    g = churn.agg(F.count(F.lit(1)).alias("customers"),
                  F.count_if(F.col("days_since_last_order") > threshold).alias("at_risk"))
    return g.select(F.lit(threshold).alias("threshold"), "customers", "at_risk",
                    (F.col("at_risk") / F.greatest(F.col("customers"), F.lit(1))).alias("at_risk_share"))


def churn_histogram(churn: DataFrame) -> DataFrame:
    """Customers per days-since-last-order bin; bins are (lo, hi]. Day 0 and anything
    above the last bound fall in no bin."""
    d = F.col("days_since_last_order")
    label = None
    for name, lo, hi in CHURN_BINS:
        cond = (d > lo) & (d <= hi)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    counts = (churn.select(label.alias("bin")).filter(F.col("bin").isNotNull())
              .groupBy("bin").agg(F.count(F.lit(1)).alias("_c")))
    bins = _label_table(churn.sparkSession, [(n, i + 1) for i, (n, _, _) in enumerate(CHURN_BINS)],
                        "bin string, bin_order int")
    return (bins.join(counts, "bin", "left")
            .select("bin", "bin_order", F.coalesce("_c", F.lit(0).cast("long")).alias("customers")))


def at_risk_customers(churn: DataFrame, threshold: int = DEFAULT_AT_RISK_THRESHOLD,
                      k: int = AT_RISK_LIST) -> DataFrame:
    return (churn.filter(F.col("days_since_last_order") > threshold)
            .orderBy(F.col("days_since_last_order").desc(), F.col("user_id").asc()).limit(k)
            .select("user_id", "days_since_last_order", "avg_inter_order_gap_days", "orders"))


def filter_sales(sales: DataFrame, categories: Sequence[str] = (),
                 locations: Sequence[str] = ()) -> DataFrame:
    """In-list filters; an empty list means no filter on that column."""
    if categories:
        sales = sales.filter(F.col("item_category").isin(list(categories)))
    if locations:
        sales = sales.filter(F.col("restaurant_id").isin(list(locations)))
    return sales


def sales_monthly(sales: DataFrame) -> DataFrame:
    return (sales.groupBy(F.trunc("order_date", "month").alias("month"))
            .agg(F.sum(as_money("net_revenue")).cast(MONEY).alias("_net"),
                 F.sum(as_money("gross_revenue")).cast(MONEY).alias("_gross"))
            .select("month", money_out("_net").alias("net_revenue"),
                    money_out("_gross").alias("gross_revenue")))


def sales_kpis(sales: DataFrame) -> DataFrame:
    """`category_order_lines` sums per-category distinct orders: an order touching two
    categories counts twice — it is not a distinct-order count."""
    g = sales.agg(F.sum(as_money("net_revenue")).cast(MONEY).alias("_net"),
                  F.sum(as_money("gross_revenue")).cast(MONEY).alias("_gross"),
                  F.sum("orders").alias("category_order_lines"))
    return g.select(money_out("_net").alias("net_revenue"), money_out("_gross").alias("gross_revenue"),
                    "category_order_lines")


def top_categories(sales: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    g = (sales.filter(F.col("item_category").isNotNull()).groupBy("item_category")
         .agg(F.sum(as_money("net_revenue")).cast(MONEY).alias("_net")))
    return (g.orderBy(F.col("_net").desc(), F.col("item_category").asc()).limit(k)
            .select("item_category", money_out("_net").alias("net_revenue")))


def loyalty_cohorts(loyalty: DataFrame) -> DataFrame:
    cohort = (F.when(F.col("is_loyalty"), F.lit(LOYALTY_LABEL))
              .when(~F.col("is_loyalty"), F.lit(NON_LOYALTY_LABEL)))
    return loyalty.select(cohort.alias("cohort"), "avg_clv", "avg_spend",
                          "avg_orders_per_customer", "repeat_order_rate", "customers")


def location_kpis(location: DataFrame) -> DataFrame:
    g = location.agg(F.count_distinct("restaurant_id").alias("locations"),
                     F.sum(as_money("total_net_revenue")).cast(MONEY).alias("_total"),
                     F.max("total_net_revenue").alias("top_location_revenue"))
    return g.select("locations", money_out("_total").alias("total_net_revenue"), "top_location_revenue")


def addon_kpis(addon: DataFrame) -> DataFrame:
    g = addon.agg(F.sum(as_money("addon_revenue")).cast(MONEY).alias("_addon"),
                  F.sum(F.when(F.col("has_paid_modifier"), F.col("orders"))).alias("_with"),
                  F.sum("orders").alias("_all"))
    return g.select(money_out("_addon").alias("addon_revenue_total"),
                    (F.coalesce(F.col("_with"), F.lit(0)) /
                     F.greatest(F.coalesce(F.col("_all"), F.lit(0)), F.lit(1))).alias("attach_rate"))


def filter_values(sales: DataFrame) -> DataFrame:
    """Distinct non-NULL values offered by the category and location filters."""
    cats = (sales.select(F.col("item_category").alias("value")).filter(F.col("value").isNotNull())
            .distinct().select(F.lit("item_category").alias("kind"), "value"))
    locs = (sales.select(F.col("restaurant_id").alias("value")).filter(F.col("value").isNotNull())
            .distinct().select(F.lit("restaurant_id").alias("kind"), "value"))
    return cats.unionByName(locs).orderBy("kind", "value")
