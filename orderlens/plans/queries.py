"""Registered queries: name → (spark, sf_dir) → DataFrame, and name → oracle SQL.

Every query reads the driver's raw tables under `sf_dir`, maps them onto the source
contracts (`sources/fixtures.py`), runs the engine, and returns the published columns.
"""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.money import money_out
from ..operators import calendar as cal_ops
from ..operators import clv, marts, profile, quality, ranking, views
from ..session import application_id, prepare, scratch_path
from ..sources import fixtures
from . import daily, jobs
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


# Silver written once per (application, data folder): every Gold query reads it back,
# as the daily chain does, instead of re-cleaning the raw tables per query.
_SILVER_ROOTS: dict[tuple[str, str], str] = {}
# The figures observed while it was written, for the quality gates.
_SILVER_FIGURES: dict[tuple[str, str], dict] = {}


def silver_lazy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver as one lazy plan from the raw tables (nothing written)."""
    prepare(spark)
    return jobs.build_silver(fixtures.order_items(spark, sf_dir),
                             fixtures.order_item_options(spark, sf_dir),
                             fixtures.DEV_APP_NAME)


def build_silver_tables(spark: SparkSession, sf_dir: str) -> str:
    """Clean the raw tables of `sf_dir` into Silver parquet under the shared checkpoint
    root (once per application) and return the Silver root."""
    prepare(spark)
    key = (application_id(spark), os.path.abspath(sf_dir))
    root = _SILVER_ROOTS.get(key)
    if root is None:
        root = scratch_path(spark, "silver")
        daily.write_silver(spark, fixtures.order_items(spark, sf_dir),
                           fixtures.order_item_options(spark, sf_dir),
                           fixtures.DEV_APP_NAME, root, _SILVER_FIGURES.setdefault(key, {}), fixtures.join_passes(spark, sf_dir))
        _SILVER_ROOTS[key] = root
    return root


def expected_lines(spark: SparkSession, sf_dir: str) -> int:
    """The lines that Silver must hold: those read, less those dropped for a reason, counted
    while Silver was written."""
    build_silver_tables(spark, sf_dir)
    return _SILVER_FIGURES[application_id(spark), os.path.abspath(sf_dir)]["expected"]


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    if os.environ.get("ORDERLENS_SILVER", "materialize") == "lazy":
        return silver_lazy(spark, sf_dir)
    return daily.read_silver(spark, build_silver_tables(spark, sf_dir))


# ------------------------------------------------------------------ Silver
@register("clean_items", O.with_("x AS (SELECT 1)", select="""
SELECT app_name, restaurant_id, creation_time_utc, order_id, user_id, printed_card_number,
       is_loyalty, currency, lineitem_id, item_category, item_name,
       CAST(item_price AS DOUBLE) AS item_price, item_quantity, order_ts, order_date, is_guest,
       CAST(gross_line AS DOUBLE) AS gross_line
FROM s_order_items"""))
def q_clean_items(spark, sf_dir):
    s = silver(spark, sf_dir)["s_order_items"]
    return s.select("app_name", "restaurant_id", "creation_time_utc", "order_id", "user_id",
                    "printed_card_number", "is_loyalty", "currency", "lineitem_id",
                    "item_category", "item_name", money_out("item_price").alias("item_price"),
                    "item_quantity", "order_ts", "order_date", "is_guest",
                    money_out("gross_line").alias("gross_line"))


@register("clean_options", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, lineitem_id, option_group_name, option_name,
       CAST(option_price AS DOUBLE) AS option_price, option_quantity,
       CAST(option_line AS DOUBLE) AS option_line
FROM s_order_item_options"""))
def q_clean_options(spark, sf_dir):
    s = silver(spark, sf_dir)["s_order_item_options"]
    return s.select("order_id", "lineitem_id", "option_group_name", "option_name",
                    money_out("option_price").alias("option_price"), "option_quantity",
                    money_out("option_line").alias("option_line"))


@register("guest_profile", O.with_("x AS (SELECT 1)", select="""
SELECT is_guest, count(*) AS lines, count(DISTINCT order_id) AS orders,
       count(DISTINCT user_id) AS customers
FROM s_order_items GROUP BY is_guest"""))
def q_guest_profile(spark, sf_dir):
    return profile.guest_profile(silver(spark, sf_dir)["s_order_items"])


@register("calendar", O.with_("x AS (SELECT 1)", select="SELECT * FROM s_date_dim"))
def q_calendar(spark, sf_dir):
    return cal_ops.in_order(silver(spark, sf_dir)["s_date_dim"])


@register("calendar_holidays", O.with_("x AS (SELECT 1)", select="""
SELECT date_key, holiday_name FROM s_date_dim WHERE is_holiday"""))
def q_calendar_holidays(spark, sf_dir):
    return cal_ops.holidays_in_range(silver(spark, sf_dir)["s_date_dim"])


@register("order_lines", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, lineitem_id, user_id, restaurant_id, order_date, item_category,
       CAST(gross_line AS DOUBLE) AS gross_line, CAST(opt_revenue AS DOUBLE) AS opt_revenue,
       CAST(net_line AS DOUBLE) AS net_line
FROM s_order_lines"""))
def q_order_lines(spark, sf_dir):
    s = silver(spark, sf_dir)["s_order_lines"]
    return s.select("order_id", "lineitem_id", "user_id", "restaurant_id", "order_date",
                    "item_category", money_out("gross_line").alias("gross_line"),
                    money_out("opt_revenue").alias("opt_revenue"),
                    money_out("net_line").alias("net_line"))


@register("orders", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, user_id, restaurant_id, is_loyalty, is_guest, order_date,
       CAST(order_net AS DOUBLE) AS order_net
FROM s_orders"""))
def q_orders(spark, sf_dir):
    s = silver(spark, sf_dir)["s_orders"]
    return s.select("order_id", "user_id", "restaurant_id", "is_loyalty", "is_guest",
                    "order_date", money_out("order_net").alias("order_net"))


@register("order_span", O.with_("x AS (SELECT 1)", select="""
SELECT min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       CAST(date_diff('day', min(order_date), max(order_date)) + 1 AS INTEGER) AS days
FROM s_orders"""))
def q_order_span(spark, sf_dir):
    o = silver(spark, sf_dir)["s_orders"]
    b = cal_ops.date_bounds(o)
    return b.select(F.col("lo").alias("first_order_date"), F.col("hi").alias("last_order_date"),
                    (F.datediff("hi", "lo") + 1).alias("days"))


# ------------------------------------------------------------------ CLV
@register("clv_daily", O.with_(O.CLV_DAILY, select="SELECT * FROM clv"))
def q_clv_daily(spark, sf_dir):
    return clv.clv_daily(silver(spark, sf_dir)["s_orders"])


@register("month_end_snapshots", O.with_(O.MONTH_END, select="SELECT snapshot_date FROM month_ends"))
def q_month_end_snapshots(spark, sf_dir):
    return cal_ops.month_end_snapshots(silver(spark, sf_dir)["s_date_dim"])


@register("clv_month_end", O.with_(O.CLV_MONTH_END, select="SELECT * FROM clv"))
def q_clv_month_end(spark, sf_dir):
    s = silver(spark, sf_dir)
    snaps = cal_ops.month_end_snapshots(s["s_date_dim"])
    return clv.clv_as_of(s["s_orders"], snaps)


# ------------------------------------------------------------------ marts
@register("rfm", O.with_(O.RFM, select="SELECT * FROM rfm"))
def q_rfm(spark, sf_dir):
    return marts.build_rfm(silver(spark, sf_dir)["s_orders"])


@register("churn", O.with_(O.CHURN, select="SELECT * FROM churn"))
def q_churn(spark, sf_dir):
    return marts.build_churn(silver(spark, sf_dir)["s_orders"])


@register("inter_order_gap", O.with_(O.CHURN, select=f"""
SELECT d.user_id, d.first_order_date, d.last_order_date, d.order_dates,
       {O.ratio('g.gap_sum', 'g.gap_n', 1)} AS avg_inter_order_gap_days
FROM (SELECT user_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
             count(DISTINCT order_date) AS order_dates FROM idents GROUP BY user_id) d
JOIN churn_gap_avg g ON d.user_id = g.user_id"""))
def q_inter_order_gap(spark, sf_dir):
    return marts.inter_order_gap(silver(spark, sf_dir)["s_orders"])


@register("inter_order_gap_rows", O.with_("x AS (SELECT 1)", select="""
SELECT user_id, order_date, lag(order_date) OVER w AS prev_order_date,
       CAST(date_diff('day', lag(order_date) OVER w, order_date) AS INTEGER) AS gap_days
FROM (SELECT DISTINCT user_id, order_date FROM idents WHERE order_date IS NOT NULL)
WINDOW w AS (PARTITION BY user_id ORDER BY order_date)"""))
def q_inter_order_gap_rows(spark, sf_dir):
    return marts.inter_order_gap_rows(silver(spark, sf_dir)["s_orders"])


@register("sales_trends", O.with_(O.SALES, select="SELECT * FROM sales"))
def q_sales_trends(spark, sf_dir):
    s = silver(spark, sf_dir)
    return marts.build_sales_trends(s["s_order_lines"], s["s_date_dim"])


@register("loyalty_impact", O.with_(O.LOYALTY, select="SELECT * FROM loyalty"))
def q_loyalty_impact(spark, sf_dir):
    return marts.build_loyalty_impact(silver(spark, sf_dir)["s_orders"])


@register("location_performance", O.with_(O.LOCATION, select="SELECT * FROM location"))
def q_location_performance(spark, sf_dir):
    return marts.build_location_performance(silver(spark, sf_dir)["s_orders"])


@register("addon_revenue", O.with_(O.ADDON, select="SELECT * FROM addon"))
def q_addon_revenue(spark, sf_dir):
    return marts.build_addon_revenue(silver(spark, sf_dir)["s_order_lines"])


# ------------------------------------------------------------------ views
# Fixed parameters the view oracles are written for.
VIEW_CATEGORIES = ["MEDIUM", "PROMO"]
VIEW_LOCATIONS = ["R0", "R5", "R13"]
VIEW_AT_RISK_SHARE_THRESHOLD = 60

_CAT_SQL = ", ".join(f"'{c}'" for c in VIEW_CATEGORIES)
_LOC_SQL = ", ".join(f"'{c}'" for c in VIEW_LOCATIONS)
_LATEST = "clv_latest AS (SELECT * FROM clv WHERE snapshot_date = (SELECT max(snapshot_date) FROM clv))"


@register("clv_overview_kpis", O.with_(O.CLV_DAILY, O.SALES, _LATEST, select=f"""
SELECT max(snapshot_date) AS snapshot_date, count(DISTINCT user_id) AS identified_customers,
       CAST(CAST(sum(CAST(cum_net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total_clv,
       (SELECT CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) FROM sales)
         AS total_net_revenue_all,
       {O.ratio(O.cents('CAST(sum(CAST(cum_net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2))'), 'count(cum_net_revenue)', 2, 2)} AS avg_clv,
       {O.ratio('sum(cum_orders)', 'count(cum_orders)', 2)} AS avg_orders
FROM clv_latest"""))
def q_clv_overview_kpis(spark, sf_dir):
    s = silver(spark, sf_dir)
    # The overview reads revenue and orders only: the CLV state without tier ranking.
    return views.clv_overview_kpis(clv.clv_daily(s["s_orders"], with_tiers=False),
                                   marts.build_sales_trends(s["s_order_lines"], s["s_date_dim"]))


_TIERS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS clv_tier, {i + 1} AS tier_order"
                                for i, t in enumerate(("High", "Medium", "Low")))


@register("clv_tier_split", O.with_(O.CLV_DAILY, _LATEST, select=f"""
SELECT t.clv_tier, t.tier_order, coalesce(c.n, 0) AS customers,
       coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER () AS share
FROM ({_TIERS_SQL}) t
LEFT JOIN (SELECT clv_tier, count(*) AS n FROM clv_latest GROUP BY clv_tier) c ON t.clv_tier = c.clv_tier"""))
def q_clv_tier_split(spark, sf_dir):
    return views.clv_tier_split(clv.clv_daily(silver(spark, sf_dir)["s_orders"]))


@register("top_customers", O.with_(O.CLV_DAILY, _LATEST, select=f"""
SELECT user_id, cum_net_revenue, cum_orders, avg_order_value, recency_days, clv_tier
FROM clv_latest ORDER BY cum_net_revenue DESC, user_id LIMIT 15"""))
def q_top_customers(spark, sf_dir):
    return views.top_customers(clv.clv_daily(silver(spark, sf_dir)["s_orders"]))


@register("rfm_segments", O.with_(O.RFM, select="""
SELECT rfm_segment, count(user_id) AS customers FROM rfm GROUP BY rfm_segment"""))
def q_rfm_segments(spark, sf_dir):
    return views.rfm_segments(marts.build_rfm(silver(spark, sf_dir)["s_orders"]))


@register("rfm_score_mix", O.with_(O.RFM, select="""
SELECT value,
       count(*) FILTER (WHERE score = 'r_score') AS r_score,
       count(*) FILTER (WHERE score = 'f_score') AS f_score,
       count(*) FILTER (WHERE score = 'm_score') AS m_score
FROM (SELECT 'r_score' AS score, r_score AS value FROM rfm
      UNION ALL SELECT 'f_score', f_score FROM rfm
      UNION ALL SELECT 'm_score', m_score FROM rfm)
GROUP BY value"""))
def q_rfm_score_mix(spark, sf_dir):
    return views.rfm_score_mix(marts.build_rfm(silver(spark, sf_dir)["s_orders"]))


@register("at_risk_share", O.with_(O.CHURN, select=f"""
SELECT {VIEW_AT_RISK_SHARE_THRESHOLD} AS threshold, count(*) AS customers,
       count(*) FILTER (WHERE days_since_last_order > {VIEW_AT_RISK_SHARE_THRESHOLD}) AS at_risk,
       (count(*) FILTER (WHERE days_since_last_order > {VIEW_AT_RISK_SHARE_THRESHOLD}))
         / greatest(count(*), 1) AS at_risk_share
FROM churn"""))
def q_at_risk_share(spark, sf_dir):
    return views.at_risk_share(marts.build_churn(silver(spark, sf_dir)["s_orders"]),
                               VIEW_AT_RISK_SHARE_THRESHOLD)


_BINS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS bin, {i + 1} AS bin_order, {lo} AS lo, {hi} AS hi"
                               for i, (n, lo, hi) in enumerate((
                                   ("0-15", 0, 15), ("16-30", 15, 30), ("31-45", 30, 45), ("46-60", 45, 60),
                                   ("61-90", 60, 90), ("91-180", 90, 180), ("180+", 180, 10000))))


@register("churn_histogram", O.with_(O.CHURN, select=f"""
SELECT b.bin, b.bin_order, count(c.user_id) AS customers
FROM ({_BINS_SQL}) b
LEFT JOIN churn c ON c.days_since_last_order > b.lo AND c.days_since_last_order <= b.hi
GROUP BY b.bin, b.bin_order"""))
def q_churn_histogram(spark, sf_dir):
    return views.churn_histogram(marts.build_churn(silver(spark, sf_dir)["s_orders"]))


@register("at_risk_customers", O.with_(O.CHURN, select=f"""
SELECT user_id, days_since_last_order, avg_inter_order_gap_days, orders FROM churn
WHERE days_since_last_order > 45
ORDER BY days_since_last_order DESC, user_id LIMIT 200"""))
def q_at_risk_customers(spark, sf_dir):
    return views.at_risk_customers(marts.build_churn(silver(spark, sf_dir)["s_orders"]))


def _sales(spark, sf_dir):
    s = silver(spark, sf_dir)
    return marts.build_sales_trends(s["s_order_lines"], s["s_date_dim"])


_FILTERED = f"""sales_f AS (SELECT * FROM sales WHERE item_category IN ({_CAT_SQL})
                               AND restaurant_id IN ({_LOC_SQL}))"""


@register("sales_filtered", O.with_(O.SALES, _FILTERED, select="SELECT * FROM sales_f"))
def q_sales_filtered(spark, sf_dir):
    return views.filter_sales(_sales(spark, sf_dir), VIEW_CATEGORIES, VIEW_LOCATIONS)


@register("sales_monthly", O.with_(O.SALES, select="""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(CAST(gross_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue
FROM sales GROUP BY 1"""))
def q_sales_monthly(spark, sf_dir):
    return views.sales_monthly(_sales(spark, sf_dir))


@register("sales_monthly_filtered", O.with_(O.SALES, _FILTERED, select="""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(CAST(gross_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue
FROM sales_f GROUP BY 1"""))
def q_sales_monthly_filtered(spark, sf_dir):
    return views.sales_monthly(views.filter_sales(_sales(spark, sf_dir), VIEW_CATEGORIES, VIEW_LOCATIONS))


@register("sales_kpis", O.with_(O.SALES, select="""
SELECT CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(CAST(gross_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue,
       CAST(sum(orders) AS BIGINT) AS category_order_lines
FROM sales"""))
def q_sales_kpis(spark, sf_dir):
    return views.sales_kpis(_sales(spark, sf_dir))


@register("top_categories", O.with_(O.SALES, select=f"""
SELECT item_category, CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue
FROM sales WHERE item_category IS NOT NULL GROUP BY item_category
ORDER BY sum(CAST(net_revenue AS DECIMAL(18,2))) DESC, item_category LIMIT 15"""))
def q_top_categories(spark, sf_dir):
    return views.top_categories(_sales(spark, sf_dir))


@register("loyalty_cohorts", O.with_(O.LOYALTY, select=f"""
SELECT CASE WHEN is_loyalty THEN 'Loyalty' WHEN NOT is_loyalty THEN 'Non-loyalty' END
         AS cohort, avg_clv, avg_spend, avg_orders_per_customer, repeat_order_rate, customers
FROM loyalty"""))
def q_loyalty_cohorts(spark, sf_dir):
    return views.loyalty_cohorts(marts.build_loyalty_impact(silver(spark, sf_dir)["s_orders"]))


@register("location_kpis", O.with_(O.LOCATION, select="""
SELECT count(DISTINCT restaurant_id) AS locations,
       CAST(CAST(sum(CAST(total_net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total_net_revenue,
       max(total_net_revenue) AS top_location_revenue
FROM location"""))
def q_location_kpis(spark, sf_dir):
    return views.location_kpis(marts.build_location_performance(silver(spark, sf_dir)["s_orders"]))


@register("addon_kpis", O.with_(O.ADDON, select="""
SELECT CAST(CAST(sum(CAST(addon_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS addon_revenue_total,
       coalesce(sum(orders) FILTER (WHERE has_paid_modifier), 0) / greatest(coalesce(sum(orders), 0), 1)
         AS attach_rate
FROM addon"""))
def q_addon_kpis(spark, sf_dir):
    return views.addon_kpis(marts.build_addon_revenue(silver(spark, sf_dir)["s_order_lines"]))


@register("filter_values", O.with_(O.SALES, select="""
SELECT DISTINCT 'item_category' AS kind, item_category AS value FROM sales WHERE item_category IS NOT NULL
UNION ALL
SELECT DISTINCT 'restaurant_id' AS kind, restaurant_id AS value FROM sales WHERE restaurant_id IS NOT NULL"""))
def q_filter_values(spark, sf_dir):
    return views.filter_values(_sales(spark, sf_dir))


# ------------------------------------------------------------------ quality
@register("calendar_coverage", O.with_("x AS (SELECT 1)", select="""
SELECT DISTINCT o.order_date FROM s_orders o
WHERE NOT EXISTS (SELECT 1 FROM s_date_dim c WHERE c.date_key = o.order_date)"""))
def q_calendar_coverage(spark, sf_dir):
    s = silver(spark, sf_dir)
    return quality.calendar_gaps(s["s_orders"], s["s_date_dim"])


@register("calendar_coverage_gaps", O.with_("x AS (SELECT 1)", select="""
SELECT DISTINCT order_date FROM s_orders WHERE order_date > DATE '1997-12-31' OR month(order_date) = 7"""))
def q_calendar_coverage_gaps(spark, sf_dir):
    """A calendar that ends with 1997 and lacks each July: the order dates outside it."""
    s = silver(spark, sf_dir)
    short = s["s_date_dim"].filter((F.col("date_key") <= "1997-12-31") & (F.col("month") != 7))
    return quality.calendar_gaps(s["s_orders"], short)


@register("qc_report", O.with_(O.CLV_DAILY, O.SALES, _LATEST, select=f"""
SELECT 'silver_order_items_count' AS gate,
       count(*) = (SELECT count(*) - count(*) FILTER (lineitem_id IS NULL OR item_name IS NULL)
                          - count(*) FILTER (lineitem_id IS NOT NULL AND item_name IS NOT NULL AND trim(app_name) = '{O.DEV}')
                   FROM src_order_items) AS passed,
       CAST(count(*) AS DOUBLE) AS observed
FROM s_order_items
UNION ALL
SELECT 'calendar_missing_dates', count(*) = 0, CAST(count(*) AS DOUBLE)
FROM (SELECT DISTINCT o.order_date FROM s_orders o
      WHERE NOT EXISTS (SELECT 1 FROM s_date_dim c WHERE c.date_key = o.order_date))
UNION ALL
SELECT 'clv_high_tier_share', coalesce(x BETWEEN 0.18 AND 0.22, false), x
FROM (SELECT (count(*) FILTER (WHERE clv_tier = 'High')) / count(*) AS x FROM clv_latest)
UNION ALL
SELECT 'clv_low_tier_share', coalesce(x BETWEEN 0.18 AND 0.22, false), x
FROM (SELECT (count(*) FILTER (WHERE clv_tier = 'Low')) / count(*) AS x FROM clv_latest)
UNION ALL
SELECT 'net_minus_gross', coalesce(x >= -0.01, false), x
FROM (SELECT CAST(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) - sum(CAST(gross_revenue AS DECIMAL(18,2)))
                       AS DECIMAL(18,2)) AS DOUBLE) AS x FROM sales)"""))
def q_qc_report(spark, sf_dir):
    s = silver(spark, sf_dir)
    return quality.qc_report(s["s_order_items"], s["s_orders"], s["s_date_dim"],
                             clv.clv_daily(s["s_orders"]),
                             marts.build_sales_trends(s["s_order_lines"], s["s_date_dim"]),
                             expected_items=expected_lines(spark, sf_dir))


# ------------------------------------------------------------------ source profile
@register("source_profile", O.with_("x AS (SELECT 1)", select="""
SELECT rows, distinct_orders, distinct_users, distinct_locations, distinct_categories, guest_lines,
       null_categories, price_min, price_median, price_max, qty_min, qty_median, qty_max,
       zero_price_lines, zero_qty_lines, negative_price_lines, unparsed_price_lines,
       distinct_currencies, null_cards, loyalty_true_lines, loyalty_false_lines, gross_revenue,
       guest_lines / rows AS guest_share, null_cards / rows AS null_card_share
FROM (
  SELECT count(*) AS rows, count(DISTINCT order_id) AS distinct_orders,
         count(DISTINCT CASE WHEN NOT g THEN user_id END) AS distinct_users,
         count(DISTINCT restaurant_id) AS distinct_locations,
         count(DISTINCT item_category) AS distinct_categories,
         count(*) FILTER (WHERE g) AS guest_lines,
         count(*) FILTER (WHERE item_category IS NULL) AS null_categories,
         min(p) AS price_min, quantile_disc(p, 0.5) AS price_median, max(p) AS price_max,
         min(q) AS qty_min, quantile_disc(q, 0.5) AS qty_median, max(q) AS qty_max,
         count(*) FILTER (WHERE p = 0) AS zero_price_lines,
         count(*) FILTER (WHERE q = 0) AS zero_qty_lines,
         count(*) FILTER (WHERE p < 0) AS negative_price_lines,
         count(*) FILTER (WHERE p IS NULL) AS unparsed_price_lines,
         count(DISTINCT currency) AS distinct_currencies,
         count(*) FILTER (WHERE printed_card_number IS NULL) AS null_cards,
         count(*) FILTER (WHERE is_loyalty = 'TRUE') AS loyalty_true_lines,
         count(*) FILTER (WHERE is_loyalty = 'FALSE') AS loyalty_false_lines,
         CAST(round(sum(CAST(p AS DECIMAL(18,6)) * q), 2) AS DOUBLE) AS gross_revenue
  FROM (SELECT order_id, user_id, restaurant_id, item_category, currency, printed_card_number, is_loyalty,
               user_id IS NULL OR trim(user_id) = '' AS g,
               CAST(TRY_CAST(item_price AS DECIMAL(18,6)) AS DOUBLE) AS p,
               CAST(trunc(TRY_CAST(item_quantity AS DOUBLE)) AS INTEGER) AS q
        FROM src_order_items))"""))
def q_source_profile(spark, sf_dir):
    prepare(spark)
    return profile.source_profile(fixtures.order_items(spark, sf_dir))


@register("grain_duplicates", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, lineitem_id, count(*) AS copies FROM s_order_items
GROUP BY order_id, lineitem_id HAVING count(*) > 1"""))
def q_grain_duplicates(spark, sf_dir):
    return profile.grain_duplicates(silver(spark, sf_dir)["s_order_items"])


@register("grain_duplicates_found", O.with_("x AS (SELECT 1)", select="""
SELECT order_id, lineitem_id, sum(n)::BIGINT AS copies
FROM (SELECT order_id, lineitem_id, 1 AS n FROM s_order_items
      UNION ALL SELECT order_id, lineitem_id, 2 FROM s_order_items WHERE CAST(order_id AS BIGINT) % 10 = 0)
GROUP BY order_id, lineitem_id HAVING sum(n) > 1"""))
def q_grain_duplicates_found(spark, sf_dir):
    """Lines of which a tenth landed three times."""
    items = silver(spark, sf_dir)["s_order_items"]
    again = items.filter(F.col("order_id").cast("long") % 10 == 0)
    return profile.grain_duplicates(items.unionByName(again).unionByName(again))


@register("orders_by_year", O.with_("x AS (SELECT 1)", select="""
SELECT CAST(year(order_date) AS INTEGER) AS year, count(DISTINCT order_id) AS orders,
       count(DISTINCT order_id) / (SELECT count(DISTINCT order_id) FROM s_orders) AS share
FROM s_orders GROUP BY 1"""))
def q_orders_by_year(spark, sf_dir):
    return profile.orders_by_year(silver(spark, sf_dir)["s_orders"])


@register("lines_by_year", O.with_("x AS (SELECT 1)", select="""
SELECT CAST(substr(creation_time_utc, 1, 4) AS INTEGER) AS year, count(*) AS lines,
       count(*) / (SELECT count(*) FROM src_order_items) AS calendar_share
FROM src_order_items GROUP BY 1"""))
def q_lines_by_year(spark, sf_dir):
    prepare(spark)
    return profile.lines_by_year(fixtures.order_items(spark, sf_dir))


@register("option_integrity", O.with_("x AS (SELECT 1)", select="""
SELECT (SELECT count(*) FROM s_order_item_options) AS options,
       (SELECT count(*) FROM s_order_item_options o WHERE NOT EXISTS (
          SELECT 1 FROM s_order_items i WHERE i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id))
         AS orphan_options,
       count(*) AS lines,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM s_order_item_options o
                        WHERE o.order_id = i.order_id AND o.lineitem_id = i.lineitem_id)) AS lines_with_option,
       (count(*) FILTER (WHERE EXISTS (SELECT 1 FROM s_order_item_options o
                        WHERE o.order_id = i.order_id AND o.lineitem_id = i.lineitem_id))) / count(*)
         AS lines_with_option_share
FROM s_order_items i"""))
def q_option_integrity(spark, sf_dir):
    s = silver(spark, sf_dir)
    return profile.option_integrity(s["s_order_items"], s["s_order_item_options"])


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


from . import io_queries  # noqa: E402,F401  (registers the round-trip queries)
