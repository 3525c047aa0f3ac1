"""The dashboard's views as SQL functions beside the published Gold tables.

`publish_views` makes one table function a view in the Gold database, so that any SQL client
gets a view by its name and arguments, e.g.

    USE gold;
    SELECT * FROM v_sales_monthly(array('PROMO'), array());
    SELECT * FROM v_at_risk_customers(45) ORDER BY days_since_last_order DESC;

A function's query is inlined where it is called: filters and columns reach the scan of the
mart as in any query. An empty array means no filter on that column. Amounts are summed as
exact decimals; averages are rounded half away from zero in whole numbers (`half_up`).
"""
from __future__ import annotations

from pyspark.sql import SparkSession

_CLV = "g_fact_customer_clv_daily"
_SALES = "(SELECT * FROM {db}.g_fact_sales_trends WHERE {both})"
_BOTH = ("(size(categories) = 0 OR array_contains(categories, item_category)) "
         "AND (size(locations) = 0 OR array_contains(locations, restaurant_id))")
_LISTS = "categories ARRAY<STRING> DEFAULT array(), locations ARRAY<STRING> DEFAULT array()"
_MONEY = "CAST(CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE)"
_LATEST = "(SELECT * FROM {db}." + _CLV + " WHERE snapshot_date = (SELECT max(snapshot_date) FROM {db}." + _CLV + "))"


def _money(c: str) -> str:
    return _MONEY.format(c=c)


#: name: (parameters, columns, query). Labels, bins and list lengths of the views.
VIEWS = {
    "v_clv_overview": ("", "snapshot_date DATE, identified_customers BIGINT, total_clv DOUBLE, total_net_revenue_all DOUBLE, avg_clv DOUBLE, avg_orders DOUBLE", f"""
        SELECT max(snapshot_date), count(DISTINCT user_id), {_money("cum_net_revenue")},
               (SELECT {_money("net_revenue")} FROM {{db}}.g_fact_sales_trends),
               {{db}}.half_up(CAST(sum(CAST(cum_net_revenue AS DECIMAL(18,2))) * 100 AS BIGINT), count(cum_net_revenue), 0) / 100D,
               {{db}}.half_up(sum(cum_orders), count(cum_orders), 2) / 100D
        FROM {_LATEST}"""),
    "v_clv_tiers": ("", "clv_tier STRING, tier_order INT, customers BIGINT, share DOUBLE", f"""
        SELECT t.clv_tier, t.tier_order, count(c.user_id), try_divide(count(c.user_id), sum(count(c.user_id)) OVER ())
        FROM VALUES ('High', 1), ('Medium', 2), ('Low', 3) AS t(clv_tier, tier_order)
        LEFT JOIN {_LATEST} c ON c.clv_tier = t.clv_tier GROUP BY t.clv_tier, t.tier_order"""),
    "v_top_customers": ("", "user_id STRING, cum_net_revenue DOUBLE, cum_orders BIGINT, avg_order_value DOUBLE, recency_days INT, clv_tier STRING", f"""
        SELECT user_id, cum_net_revenue, cum_orders, avg_order_value, recency_days, clv_tier
        FROM {_LATEST} ORDER BY cum_net_revenue DESC, user_id LIMIT 15"""),
    "v_rfm_segments": ("", "rfm_segment STRING, customers BIGINT", """
        SELECT rfm_segment, count(user_id) FROM {db}.g_dim_customer_rfm GROUP BY rfm_segment"""),
    "v_rfm_score_mix": ("", "value INT, r_score BIGINT, f_score BIGINT, m_score BIGINT", """
        SELECT value, count_if(score = 'r'), count_if(score = 'f'), count_if(score = 'm')
        FROM {db}.g_dim_customer_rfm LATERAL VIEW stack(3, 'r', r_score, 'f', f_score, 'm', m_score) s AS score, value GROUP BY value"""),
    "v_at_risk_share": ("days INT DEFAULT 60", "threshold INT, customers BIGINT, at_risk BIGINT, at_risk_share DOUBLE", """
        SELECT days, n, late, late / greatest(n, 1)
        FROM (SELECT count(1) AS n, count_if(is_late) AS late
              FROM (SELECT days_since_last_order > days AS is_late FROM {db}.g_fact_churn_indicators))"""),
    "v_churn_histogram": ("", "bin STRING, bin_order INT, customers BIGINT", """
        SELECT b.bin, b.bin_order, coalesce(c.n, 0)
        FROM VALUES ('0-15', 1), ('16-30', 2), ('31-45', 3), ('46-60', 4), ('61-90', 5), ('91-180', 6), ('180+', 7) AS b(bin, bin_order)
        LEFT JOIN (SELECT CASE WHEN days_since_last_order <= 0 THEN 0 WHEN days_since_last_order <= 15 THEN 1 WHEN days_since_last_order <= 30 THEN 2
                               WHEN days_since_last_order <= 45 THEN 3 WHEN days_since_last_order <= 60 THEN 4 WHEN days_since_last_order <= 90 THEN 5
                               WHEN days_since_last_order <= 180 THEN 6 WHEN days_since_last_order <= 10000 THEN 7 END AS k, count(1) AS n
                   FROM {db}.g_fact_churn_indicators GROUP BY 1) c ON c.k = b.bin_order"""),
    "v_at_risk_customers": ("days INT DEFAULT 45", "user_id STRING, days_since_last_order INT, avg_inter_order_gap_days DOUBLE, orders BIGINT", """
        SELECT user_id, days_since_last_order, avg_inter_order_gap_days, orders FROM {db}.g_fact_churn_indicators
        WHERE days_since_last_order > days ORDER BY days_since_last_order DESC, user_id LIMIT 200"""),
    "v_sales": (_LISTS, "order_date DATE, restaurant_id STRING, item_category STRING, orders BIGINT, gross_revenue DOUBLE, net_revenue DOUBLE, "
                "year INT, month INT, week INT, is_weekend BOOLEAN, is_holiday BOOLEAN, holiday_name STRING", f"""
        SELECT order_date, restaurant_id, item_category, orders, gross_revenue, net_revenue, year, month, week, is_weekend, is_holiday, holiday_name
        FROM {_SALES}"""),
    "v_sales_monthly": (_LISTS, "month DATE, net_revenue DOUBLE, gross_revenue DOUBLE", f"""
        SELECT CAST(trunc(order_date, 'month') AS DATE), {_money("net_revenue")}, {_money("gross_revenue")} FROM {_SALES} GROUP BY 1"""),
    "v_sales_kpis": (_LISTS, "net_revenue DOUBLE, gross_revenue DOUBLE, category_order_lines BIGINT", f"""
        SELECT {_money("net_revenue")}, {_money("gross_revenue")}, sum(orders) FROM {_SALES}"""),
    "v_top_categories": (_LISTS, "item_category STRING, net_revenue DOUBLE", f"""
        SELECT item_category, {_money("net_revenue")} FROM {_SALES} WHERE item_category IS NOT NULL
        GROUP BY item_category ORDER BY 2 DESC, 1 LIMIT 15"""),
    "v_loyalty_cohorts": ("", "cohort STRING, avg_clv DOUBLE, avg_spend DOUBLE, avg_orders_per_customer DOUBLE, repeat_order_rate DOUBLE, customers BIGINT", """
        SELECT CASE WHEN is_loyalty THEN 'Loyalty' WHEN NOT is_loyalty THEN 'Non-loyalty' END, avg_clv, avg_spend, avg_orders_per_customer,
               repeat_order_rate, customers FROM {db}.g_fact_loyalty_impact"""),
    "v_location_kpis": ("", "locations BIGINT, total_net_revenue DOUBLE, top_location_revenue DOUBLE", f"""
        SELECT count(DISTINCT restaurant_id), {_money("total_net_revenue")}, max(total_net_revenue) FROM {{db}}.g_fact_location_performance"""),
    "v_addon_kpis": ("", "addon_revenue_total DOUBLE, attach_rate DOUBLE", f"""
        SELECT {_money("addon_revenue")}, coalesce(sum(orders) FILTER (WHERE has_paid_modifier), 0) / greatest(coalesce(sum(orders), 0), 1)
        FROM {{db}}.g_fact_addon_revenue"""),
    "v_filter_values": ("", "kind STRING, value STRING", """
        SELECT DISTINCT s.kind, s.value FROM {db}.g_fact_sales_trends
        LATERAL VIEW stack(2, 'item_category', item_category, 'restaurant_id', restaurant_id) s AS kind, value WHERE s.value IS NOT NULL"""),
}


def publish_views(spark: SparkSession, database: str, temporary: bool = False) -> list[str]:
    """Make the functions over the Gold tables published in `database`: in that database (a
    client calls them after `USE database`, as Spark looks table functions up in the current
    one), or for this session only. Returns their names."""
    db = f"`{database}`"
    kind, at = ("TEMPORARY FUNCTION", "") if temporary else ("FUNCTION", f"{db}.")
    spark.sql(f"""CREATE OR REPLACE {kind} {at}half_up(num BIGINT, den BIGINT, places INT) RETURNS BIGINT
        RETURN CASE WHEN den <> 0 THEN CAST(sign(num) * sign(den) AS BIGINT)
                                       * ((2 * abs(num) * CAST(pow(10, places) AS BIGINT) + abs(den)) div (2 * abs(den))) END""")
    for name, (parameters, columns, query) in VIEWS.items():
        text = query.replace("{both}", _BOTH).replace("{db}.half_up", f"{at}half_up").replace("{db}", db)
        spark.sql(f"CREATE OR REPLACE {kind} {at}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {text}")
    return list(VIEWS)
