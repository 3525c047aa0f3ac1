"""Independent SQL statements of every registered query, for DuckDB.

Each statement starts from the driver's raw tables (lineitem, orders, part), applies
the fixture mapping and the cleaning rules in plain SQL, and computes the same result
with plain window functions and aggregates — no rewrites. Agreement between the Spark
plan and this SQL is the correctness check.

The statements hold all constants of the rules as literals of their own, so a change of one
in the engine shows as a difference.

Conventions shared with the Spark side: money is exact DECIMAL(18,2) and published as
DOUBLE; rounded ratios are exact integer arithmetic, half away from zero; every rank
breaks ties by the id column; integer results are cast to the types Spark produces.
"""
from __future__ import annotations


def ratio(num: str, den: str, scale: int, num_scale: int = 0) -> str:
    """round(num/den, scale) half away from zero as DOUBLE, from integer SQL operands."""
    shift = scale - num_scale
    n = f"abs(CAST({num} AS BIGINT))"
    d = f"abs(CAST({den} AS BIGINT))"
    if shift >= 0:
        n = f"({n} * {10 ** shift})"
    else:
        d = f"({d} * {10 ** (-shift)})"
    units = f"((2 * {n} + {d}) // (2 * {d}))"
    value = f"(CAST({units} AS DOUBLE) / CAST({10 ** scale} AS DOUBLE))"
    return (f"(CASE WHEN ({num}) IS NULL OR ({den}) IS NULL OR ({den}) = 0 THEN NULL "
            f"WHEN (({num}) < 0) <> (({den}) < 0) THEN -{value} ELSE {value} END)")


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


# The federal holidays of 1992 to 2002, the years of the driver's orders, and the
# working days on which those of a weekend are observed.
HOLIDAYS = {
    "New Year's Day":
        "1992-01-01 1993-01-01 1994-01-01 1995-01-01 1996-01-01 1997-01-01 "
        "1998-01-01 1999-01-01 2000-01-01 2001-01-01 2002-01-01",
    "New Year's Day (observed)":
        "1993-12-31 1995-01-02 1999-12-31",
    "Martin Luther King Jr. Day":
        "1992-01-20 1993-01-18 1994-01-17 1995-01-16 1996-01-15 1997-01-20 "
        "1998-01-19 1999-01-18 2000-01-17 2001-01-15 2002-01-21",
    "Washington's Birthday":
        "1992-02-17 1993-02-15 1994-02-21 1995-02-20 1996-02-19 1997-02-17 "
        "1998-02-16 1999-02-15 2000-02-21 2001-02-19 2002-02-18",
    "Memorial Day":
        "1992-05-25 1993-05-31 1994-05-30 1995-05-29 1996-05-27 1997-05-26 "
        "1998-05-25 1999-05-31 2000-05-29 2001-05-28 2002-05-27",
    "Independence Day":
        "1992-07-04 1993-07-04 1994-07-04 1995-07-04 1996-07-04 1997-07-04 "
        "1998-07-04 1999-07-04 2000-07-04 2001-07-04 2002-07-04",
    "Independence Day (observed)":
        "1992-07-03 1993-07-05 1998-07-03 1999-07-05",
    "Labor Day":
        "1992-09-07 1993-09-06 1994-09-05 1995-09-04 1996-09-02 1997-09-01 "
        "1998-09-07 1999-09-06 2000-09-04 2001-09-03 2002-09-02",
    "Columbus Day":
        "1992-10-12 1993-10-11 1994-10-10 1995-10-09 1996-10-14 1997-10-13 "
        "1998-10-12 1999-10-11 2000-10-09 2001-10-08 2002-10-14",
    "Veterans Day":
        "1992-11-11 1993-11-11 1994-11-11 1995-11-11 1996-11-11 1997-11-11 "
        "1998-11-11 1999-11-11 2000-11-11 2001-11-11 2002-11-11",
    "Veterans Day (observed)":
        "1995-11-10 2000-11-10 2001-11-12",
    "Thanksgiving":
        "1992-11-26 1993-11-25 1994-11-24 1995-11-23 1996-11-28 1997-11-27 "
        "1998-11-26 1999-11-25 2000-11-23 2001-11-22 2002-11-28",
    "Christmas Day":
        "1992-12-25 1993-12-25 1994-12-25 1995-12-25 1996-12-25 1997-12-25 "
        "1998-12-25 1999-12-25 2000-12-25 2001-12-25 2002-12-25",
    "Christmas Day (observed)":
        "1993-12-24 1994-12-26 1999-12-24",
}


def _holiday_sql() -> str:
    rows = [f"(DATE '{day}', '{name.replace(chr(39), chr(39) * 2)}')" for name, days in HOLIDAYS.items() for day in days.split()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS h(h_date, holiday_name)"


DEV = "shop - DEVELOPMENT"

BASE = f"""
WITH src_order_items AS (
  SELECT
    CASE WHEN o.o_orderkey % 251 = 0
         THEN CASE WHEN o.o_orderkey % 2 = 0 THEN '{DEV}' ELSE '  {DEV}  ' END
         ELSE 'shop' END                                   AS app_name,
    concat('R', CAST(o.o_orderkey % 27 AS VARCHAR))         AS restaurant_id,
    concat(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR), 'T10:00:00',
           CASE WHEN o.o_orderkey % 3 = 0 THEN 'Z' ELSE '.123Z' END)    AS creation_time_utc,
    CAST(o.o_orderkey AS VARCHAR)                                       AS order_id,
    CASE WHEN o.o_custkey % 11 <> 0 THEN CAST(o.o_custkey AS VARCHAR)
         WHEN o.o_orderkey % 3 = 0 THEN NULL
         WHEN o.o_orderkey % 3 = 1 THEN '' ELSE '   ' END               AS user_id,
    CASE WHEN o.o_orderpriority = '1-URGENT'
         THEN concat('C', CAST(o.o_custkey AS VARCHAR)) END             AS printed_card_number,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'FALSE' END AS is_loyalty,
    'USD'                                                               AS currency,
    CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 9973 = 0 THEN NULL
         ELSE concat(CAST(l.l_linenumber AS VARCHAR), '-', CAST(l.l_partkey AS VARCHAR),
                     '-', CAST(l.l_suppkey AS VARCHAR)) END             AS lineitem_id,
    p.p_type                                                            AS item_category,
    CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 9973 = 0 THEN NULL
         ELSE p.p_name END                                              AS item_name,
    CAST(p.p_retailprice AS VARCHAR)                                    AS item_price,
    CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR)                      AS item_quantity
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part   p ON l.l_partkey  = p.p_partkey
),
src_opt_one AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         concat(CAST(l_linenumber AS VARCHAR), '-', CAST(l_partkey AS VARCHAR), '-',
                CAST(l_suppkey AS VARCHAR)) AS lineitem_id,
         concat('G', CAST(l_linenumber AS VARCHAR)) AS option_group_name,
         l_returnflag AS option_name,
         CAST(CAST(CAST(round(l_tax * 100) AS INTEGER) * 25 / 100.0 AS DECIMAL(9,2)) AS VARCHAR)
           AS option_price,
         '1' AS option_quantity,
         l_orderkey AS k
  FROM lineitem WHERE l_linenumber % 2 = 0
),
src_order_item_options AS (
  SELECT order_id, lineitem_id, option_group_name, option_name, option_price, option_quantity
  FROM src_opt_one
  UNION ALL
  SELECT order_id, lineitem_id, option_group_name, option_name, option_price, option_quantity
  FROM src_opt_one WHERE k % 89 = 0
),
s_items_0 AS (
  SELECT app_name, restaurant_id, creation_time_utc, order_id,
         CASE WHEN trim(user_id) = '' THEN NULL ELSE user_id END AS user_id,
         printed_card_number,
         lower(is_loyalty) = 'true' AS is_loyalty,
         currency, lineitem_id, item_category, item_name,
         TRY_CAST(item_price AS DECIMAL(18,6)) AS item_price,
         CAST(trunc(TRY_CAST(item_quantity AS DOUBLE)) AS INTEGER) AS item_quantity,
         coalesce(try_strptime(creation_time_utc, '%Y-%m-%dT%H:%M:%S.%fZ'),
                  try_strptime(creation_time_utc, '%Y-%m-%dT%H:%M:%S.%gZ'),
                  try_strptime(creation_time_utc, '%Y-%m-%dT%H:%M:%SZ')) AS order_ts
  FROM src_order_items
  WHERE lineitem_id IS NOT NULL AND item_name IS NOT NULL AND trim(app_name) <> '{DEV}'
),
s_order_items AS (
  SELECT *, CAST(order_ts AS DATE) AS order_date, user_id IS NULL AS is_guest,
         CAST(round(item_price * item_quantity, 2) AS DECIMAL(18,2)) AS gross_line
  FROM s_items_0
),
s_opt_0 AS (SELECT DISTINCT * FROM src_order_item_options),
s_order_item_options AS (
  SELECT order_id, lineitem_id, option_group_name, option_name,
         TRY_CAST(option_price AS DECIMAL(18,6)) AS option_price,
         CAST(trunc(TRY_CAST(option_quantity AS DOUBLE)) AS INTEGER) AS option_quantity,
         CAST(round(TRY_CAST(option_price AS DECIMAL(18,6))
                    * CAST(trunc(TRY_CAST(option_quantity AS DOUBLE)) AS INTEGER), 2)
              AS DECIMAL(18,2)) AS option_line
  FROM s_opt_0
),
opt_totals AS (
  SELECT order_id, lineitem_id, CAST(sum(option_line) AS DECIMAL(18,2)) AS opt_revenue
  FROM s_order_item_options GROUP BY order_id, lineitem_id
),
s_order_lines AS (
  SELECT i.*, coalesce(t.opt_revenue, CAST(0 AS DECIMAL(18,2))) AS opt_revenue,
         CAST(i.gross_line + coalesce(t.opt_revenue, 0) AS DECIMAL(18,2)) AS net_line
  FROM s_order_items i LEFT JOIN opt_totals t
    ON i.order_id = t.order_id AND i.lineitem_id = t.lineitem_id
),
s_orders AS (
  SELECT order_id, user_id, restaurant_id, is_loyalty, is_guest, order_date,
         CAST(sum(net_line) AS DECIMAL(18,2)) AS order_net
  FROM s_order_lines
  GROUP BY order_id, user_id, restaurant_id, is_loyalty, is_guest, order_date
),
idents AS (SELECT * FROM s_orders WHERE user_id IS NOT NULL),
bounds AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM s_order_items),
ad AS (SELECT max(order_date) AS d FROM s_orders),
hol_rows AS (
    {_holiday_sql()}
),
holidays AS (
  SELECT h_date, string_agg(DISTINCT holiday_name, ', ' ORDER BY holiday_name) AS holiday_name
  FROM hol_rows WHERE h_date IS NOT NULL GROUP BY h_date
),
days AS (
  SELECT CAST(d AS DATE) AS date_key
  FROM bounds, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
),
s_date_dim AS (
  SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
         CAST(weekofyear(date_key) AS INTEGER) AS week, dayname(date_key) AS day_of_week,
         isodow(date_key) IN (6, 7) AS is_weekend,
         h.h_date IS NOT NULL AS is_holiday, h.holiday_name
  FROM days LEFT JOIN holidays h ON days.date_key = h.h_date
)"""


# ------------------------------------------------------------------ CLV pieces
def _clv_finish(state: str) -> str:
    return f"""
SELECT user_id, snapshot_date, CAST(cum_net_revenue AS DOUBLE) AS cum_net_revenue, cum_orders,
       first_order_date, last_order_date,
       CAST(date_diff('day', last_order_date, snapshot_date) AS INTEGER) AS recency_days,
       {ratio(cents('cum_net_revenue'), 'cum_orders', 2, 2)} AS avg_order_value,
       CASE ntile(5) OVER (PARTITION BY snapshot_date ORDER BY cum_net_revenue, user_id)
            WHEN 5 THEN 'High' WHEN 1 THEN 'Low' ELSE 'Medium' END AS clv_tier
FROM {state}"""


CLV_DAILY_STATE = """clv_state AS (
  SELECT user_id, (SELECT d FROM ad) AS snapshot_date,
         CAST(sum(order_net) AS DECIMAL(18,2)) AS cum_net_revenue,
         count(DISTINCT order_id) AS cum_orders,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM idents WHERE order_date <= (SELECT d FROM ad)
  GROUP BY user_id
)"""

MONTH_END = """month_ends AS (
  SELECT max(date_key) AS snapshot_date FROM s_date_dim GROUP BY year, month
)"""

# The naive statement of the as-of CLV: every order joined to every later snapshot.
CLV_MONTH_END_STATE = MONTH_END + """,
clv_state AS (
  SELECT o.user_id, s.snapshot_date,
         CAST(sum(o.order_net) AS DECIMAL(18,2)) AS cum_net_revenue,
         count(DISTINCT o.order_id) AS cum_orders,
         min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date
  FROM idents o JOIN month_ends s ON o.order_date <= s.snapshot_date
  GROUP BY o.user_id, s.snapshot_date
)"""


CLV_DAILY = CLV_DAILY_STATE + ",\nclv AS (" + _clv_finish("clv_state") + ")"
CLV_MONTH_END = CLV_MONTH_END_STATE + ",\nclv AS (" + _clv_finish("clv_state") + ")"


RFM = f"""rfm_base AS (
  SELECT user_id, CAST(date_diff('day', max(order_date), (SELECT d FROM ad)) AS INTEGER) AS recency,
         count(DISTINCT order_id) AS frequency,
         CAST(sum(order_net) AS DECIMAL(18,2)) AS monetary
  FROM idents GROUP BY user_id
),
rfm_scored AS (
  SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency, user_id) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary, user_id) AS INTEGER) AS m_score
  FROM rfm_base
),
rfm AS (
  SELECT user_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
              WHEN r_score <= 2 AND f_score <= 2 THEN 'Churn-Risk'
              ELSE 'Other' END AS rfm_segment,
         CAST((SELECT d FROM ad) AS VARCHAR) AS analysis_date
  FROM rfm_scored
)"""

P = 90
CHURN = f"""churn_dates AS (SELECT DISTINCT user_id, order_date FROM idents),
churn_gaps AS (
  SELECT user_id, date_diff('day', lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date),
                            order_date) AS gap
  FROM churn_dates
),
churn_gap_avg AS (
  SELECT user_id, sum(gap) AS gap_sum, count(gap) AS gap_n FROM churn_gaps GROUP BY user_id
),
churn_recent AS (
  SELECT user_id, sum(order_net) AS recent FROM idents
  WHERE date_diff('day', order_date, (SELECT d FROM ad)) < {P} GROUP BY user_id
),
churn_prior AS (
  SELECT user_id, sum(order_net) AS prior FROM idents
  WHERE date_diff('day', order_date, (SELECT d FROM ad)) >= {P}
    AND date_diff('day', order_date, (SELECT d FROM ad)) < {2 * P} GROUP BY user_id
),
churn_base AS (
  SELECT user_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS orders,
         CAST(date_diff('day', max(order_date), (SELECT d FROM ad)) AS INTEGER) AS days_since_last_order
  FROM idents GROUP BY user_id
),
churn AS (
  SELECT b.user_id, CAST((SELECT d FROM ad) AS VARCHAR) AS analysis_date, b.days_since_last_order,
         {ratio('g.gap_sum', 'g.gap_n', 1)} AS avg_inter_order_gap_days,
         CASE WHEN p.prior IS NULL OR p.prior = 0 THEN NULL
              ELSE {ratio(cents('coalesce(r.recent, 0)') + ' - ' + cents('p.prior'), cents('p.prior'), 3)}
         END AS pct_spend_change,
         b.days_since_last_order > 45 AS at_risk_flag,
         b.orders
  FROM churn_base b
  LEFT JOIN churn_gap_avg g ON b.user_id = g.user_id
  LEFT JOIN churn_recent r ON b.user_id = r.user_id
  LEFT JOIN churn_prior p ON b.user_id = p.user_id
)"""

SALES = """sales AS (
  SELECT a.order_date, a.restaurant_id, a.item_category, a.orders,
         CAST(a.gross_revenue AS DOUBLE) AS gross_revenue, CAST(a.net_revenue AS DOUBLE) AS net_revenue,
         c.year, c.month, c.week, c.is_weekend, c.is_holiday, c.holiday_name
  FROM (SELECT order_date, restaurant_id, item_category, count(DISTINCT order_id) AS orders,
               CAST(sum(gross_line) AS DECIMAL(18,2)) AS gross_revenue,
               CAST(sum(net_line) AS DECIMAL(18,2)) AS net_revenue
        FROM s_order_lines GROUP BY order_date, restaurant_id, item_category) a
  LEFT JOIN s_date_dim c ON a.order_date = c.date_key
)"""

LOYALTY = f"""loyalty_user AS (
  SELECT is_loyalty, user_id, count(DISTINCT order_id) AS orders,
         CAST(sum(order_net) AS DECIMAL(18,2)) AS spend
  FROM idents GROUP BY is_loyalty, user_id
),
loyalty AS (
  SELECT is_loyalty, count(DISTINCT user_id) AS customers,
         {ratio('sum(' + cents('spend') + ')', 'count(spend)', 2, 2)} AS avg_spend,
         {ratio('sum(orders)', 'count(orders)', 3)} AS avg_orders_per_customer,
         {ratio('count(*) FILTER (WHERE orders > 1)', 'count(*)', 3)} AS repeat_order_rate,
         {ratio('sum(' + cents('spend') + ')', 'count(spend)', 2, 2)} AS avg_clv
  FROM loyalty_user GROUP BY is_loyalty
)"""

LOCATION = f"""loc_span AS (
  SELECT date_diff('day', min(order_date), max(order_date)) + 1 AS span FROM s_orders
),
loc_agg AS (
  SELECT restaurant_id, CAST(sum(order_net) AS DECIMAL(18,2)) AS total_net_revenue,
         count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS customers
  FROM s_orders GROUP BY restaurant_id
),
location AS (
  SELECT restaurant_id, CAST(total_net_revenue AS DOUBLE) AS total_net_revenue, orders, customers,
         {ratio(cents('total_net_revenue'), 'orders', 2, 2)} AS aov,
         {ratio('orders', '(SELECT span FROM loc_span)', 2)} AS orders_per_day,
         CAST(row_number() OVER (ORDER BY total_net_revenue DESC, restaurant_id) AS INTEGER) AS revenue_rank
  FROM loc_agg
)"""

ADDON = f"""addon_order AS (
  SELECT order_id, CAST(sum(gross_line) AS DECIMAL(18,2)) AS gross_revenue,
         CAST(sum(opt_revenue) AS DECIMAL(18,2)) AS addon_revenue
  FROM s_order_lines GROUP BY order_id
),
addon AS (
  SELECT addon_revenue > 0 AS has_paid_modifier, count(DISTINCT order_id) AS orders,
         CAST(CAST(sum(gross_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue,
         CAST(CAST(sum(addon_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS addon_revenue,
         {ratio('sum(' + cents('gross_revenue') + ')', 'count(gross_revenue)', 2, 2)} AS aov
  FROM addon_order GROUP BY addon_revenue > 0
)"""


def with_(*ctes: str, select: str) -> str:
    return BASE + ",\n" + ",\n".join(ctes) + "\n" + select
