"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

Each statement runs on the raw test tables (pre-registered views) and
rebuilds the star with the mapping of FIXTURES.md §4. The statements are written
independently of the Spark plans: one sum per order from a union of items and
options, ranks by counting, fifths by arithmetic, gaps from first and last date,
previous months by a self-join, periods by grouping sets. Conventions shared with the
Spark side: ``as_of = DATE '2002-01-01'``; money summed as DECIMAL and turned
into DOUBLE at the end; averages as CAST(SUM AS DOUBLE) / COUNT; rounded
averages of whole numbers rounded exactly (half away from zero) in integers;
NTILE ties broken by ``user_id``.
"""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"
AS_OF_TS = "TIMESTAMP '2002-01-01 00:00:00'"
MARK_TS = "TIMESTAMP '2001-06-01 00:00:00'"

STAR = """
order_items AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS lineitem_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS app_name, n_name AS restaurant_id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
    CAST(o_custkey % 10000 AS VARCHAR) AS printed_card_number,
    c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_loyalty,
    o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS creation_time_utc,
    'USD' AS currency, p_type AS item_category, p_name AS item_name,
    CAST(l_quantity AS INTEGER) AS item_quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(20,4)) AS item_price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
order_item_options AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS lineitem_id,
    'DISCOUNT' AS option_group_name, l_returnflag AS option_name, 1 AS option_quantity,
    CAST(-CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(20,4)) AS option_price
  FROM lineitem WHERE l_discount >= 0.08
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), 'EXTRA', l_linestatus, 1,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(20,4))
  FROM lineitem WHERE l_tax >= 0.06
),
fact_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, n_name AS restaurant_id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'UNKNOWN'
         ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
    CAST(o_custkey % 10000 AS VARCHAR) AS printed_card_number,
    c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_loyalty,
    o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS creation_time_utc, 'USD' AS currency_used
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
fact_items AS (
  SELECT lineitem_id, order_id, item_category, item_name, item_quantity, item_price,
    CAST(item_quantity * item_price AS DECIMAL(30,4)) AS item_total
  FROM order_items
),
fact_items_options AS (
  SELECT DISTINCT lineitem_id, order_id, option_group_name, option_name,
    CAST(option_quantity AS DECIMAL(12,4)) AS option_quantity, option_price,
    CAST(option_quantity * option_price AS DECIMAL(30,4)) AS option_total
  FROM order_item_options
),
date_dim AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS year,
    EXTRACT(MONTH FROM o_orderdate) = 12 AND EXTRACT(DAY FROM o_orderdate) = 25 AS is_holiday
  FROM orders
),
sums AS (
  SELECT order_id, SUM(i) AS i, SUM(x) AS x, MAX(neg) AS neg
  FROM (SELECT order_id, item_total AS i, NULL AS x, NULL AS neg FROM fact_items
        UNION ALL SELECT order_id, NULL, option_total, CAST(option_price < 0 AS INTEGER) FROM fact_items_options)
  GROUP BY order_id
),
raw AS (SELECT * FROM fact_orders LEFT JOIN sums USING (order_id)),
totals_a AS (
  SELECT * EXCLUDE (i, x, neg), COALESCE(i, 0) AS item_total, COALESCE(x, 0) AS option_total,
    COALESCE(i, 0) + COALESCE(x, 0) AS order_total FROM raw
),
totals_b AS (
  SELECT * EXCLUDE (i, x, neg), i AS item_total, x AS option_total,
    CASE WHEN i IS NULL OR x IS NULL THEN 0 ELSE i + x END AS order_total FROM raw
),
totals_c AS (
  SELECT * EXCLUDE (i, x, neg), i AS item_total, COALESCE(x, 0) AS option_total, i + COALESCE(x, 0) AS order_total,
    COALESCE(neg, 0) AS has_discount FROM raw
)"""


def _with(body: str, *extra: str) -> str:
    ctes = STAR + "".join(",\n" + e for e in extra)
    return f"WITH {ctes}\n{body}"


def _half_up(num: str, den: str, digits: int) -> str:
    """Exact round(num / den, digits) for integers, den > 0 (NULL otherwise)."""
    scale = 10 ** digits
    return (f"CASE WHEN ({den}) > 0 THEN CAST(sign({num}) * ((2 * {scale} * abs({num}) + ({den})) "
            f"// (2 * ({den}))) AS DOUBLE) / {scale} END")


def _round_double(x: str, digits: int) -> str:
    """Round a DOUBLE half-up on its shortest decimal text (as Spark's round does)."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,4))) AS DOUBLE)"


# ----------------------------------------------------------------------------- reports
def _order_totals(cte: str) -> str:
    return _with(f"SELECT order_id, user_id, CAST(item_total AS DOUBLE) AS item_total, "
                 f"CAST(option_total AS DOUBLE) AS option_total, CAST(order_total AS DOUBLE) AS order_total FROM {cte}")


# share of users that spend less: all at or below this value without its peers
CLV = _with("""SELECT user_id, CAST(ti AS DOUBLE) AS total_item_cost, CAST(tx AS DOUBLE) AS total_option_cost,
  CAST(tt AS DOUBLE) AS total_cost_per_user, clv_percent,
  CASE WHEN clv_percent < 20 THEN 'Low CLV' WHEN clv_percent < 80 THEN 'Medium CLV' ELSE 'High CLV' END AS clv_tag
FROM (SELECT *, CASE WHEN n > 1 THEN ROUND(CAST(upto - peers AS DOUBLE) / (n - 1) * 100, 3) ELSE 0.0 END AS clv_percent
  FROM spread)""",
            """spread AS (SELECT *, COUNT(*) OVER (ORDER BY tt RANGE UNBOUNDED PRECEDING) AS upto,
  COUNT(*) OVER (PARTITION BY tt) AS peers, COUNT(*) OVER () AS n
  FROM (SELECT user_id, SUM(item_total) AS ti, SUM(option_total) AS tx, SUM(order_total) AS tt
        FROM totals_a GROUP BY user_id))""")


def _fifth(order: str) -> str:
    """NTILE(5) by arithmetic on the row number: the first n % 5 parts have one row more."""
    p, big = f"(ROW_NUMBER() OVER (ORDER BY {order}))", "(n % 5)"
    return (f"CAST(CASE WHEN {p} <= {big} * (n // 5 + 1) THEN ({p} - 1) // (n // 5 + 1) + 1 "
            f"ELSE {big} + ({p} - {big} * (n // 5 + 1) - 1) // GREATEST(n // 5, 1) + 1 END AS INTEGER)")


RFM_SEGMENTED = _with(f"""SELECT *, CASE WHEN (recency_rank, frequency_rank, monetary_rank) = (1, 1, 1) THEN 'VIP'
  WHEN frequency_rank < 4 THEN 'Other' WHEN recency_rank = 1 THEN 'New Customer'
  WHEN recency_rank >= 4 THEN 'Churn Risk' ELSE 'Other' END AS customer_segment
FROM (SELECT user_id, CAST(spend AS DOUBLE) AS total_cost_per_user, days_passed, num_purchases_last_24_months,
  {_fifth("spend DESC NULLS LAST, user_id")} AS monetary_rank,
  {_fifth("days_passed NULLS LAST, user_id")} AS recency_rank,
  {_fifth("num_purchases_last_24_months DESC, user_id")} AS frequency_rank FROM per_user)""",
                      f"""per_user AS (SELECT user_id, SUM(order_total) AS spend,
  date_sub('day', MAX(creation_time_utc), {AS_OF_TS}) AS days_passed,
  COUNT(*) FILTER (WHERE creation_time_utc >= TIMESTAMP '2000-01-01 00:00:00') AS num_purchases_last_24_months,
  COUNT(*) OVER () AS n FROM totals_a GROUP BY user_id)""")

# days between consecutive dates add up to last - first; the month before is the latest earlier one
_CHURN_CTES = (
    "dated AS (SELECT user_id, CAST(creation_time_utc AS DATE) AS d, order_total FROM totals_b)",
    f"spans AS (SELECT user_id, MAX(d) AS last_d, MAX(d) - MIN(d) AS gsum, COUNT(d) - 1 AS gcnt, "
    f"CAST({AS_OF} - MAX(d) AS INTEGER) AS ago FROM dated GROUP BY user_id)",
    "months AS (SELECT user_id, make_date(year(d), month(d), 1) AS m, SUM(order_total) AS t FROM dated GROUP BY ALL)",
    "changes AS (SELECT user_id, m, t, p, CAST(t * 10000 AS HUGEINT) AS c4, CAST(p * 10000 AS HUGEINT) AS p4 FROM ("
    "SELECT a.user_id, a.m, ANY_VALUE(a.t) AS t, arg_max(b.t, b.m) AS p FROM months a LEFT JOIN months b "
    "ON b.user_id = a.user_id AND b.m < a.m GROUP BY a.user_id, a.m))",
    "pct AS (SELECT user_id, m, t, p, CASE WHEN p >= 1 THEN "
    "CAST(sign(c4 - p4) * ((20000 * abs(c4 - p4) + p4) // (2 * p4)) AS DOUBLE) / 100 END AS pct FROM changes)",
    "newest AS (SELECT user_id, pct FROM pct WHERE m = (SELECT MAX(m) FROM months))",
)

AVG_GAP = _with(f"SELECT user_id, {_half_up('gsum', 'gcnt', 2)} AS avg_days_between_orders FROM spans", *_CHURN_CTES)
RECENCY = _with("SELECT user_id, last_d AS last_order_date, ago AS days_since_last_order FROM spans", *_CHURN_CTES)
MONTHLY_CHANGE = _with("SELECT user_id, m AS month_start, CAST(t AS DOUBLE) AS monthly_total, "
                       "CAST(p AS DOUBLE) AS prev_month_total, pct AS pct_change_last_month FROM pct", *_CHURN_CTES)
LAST_MONTH_CHANGE = _with("SELECT user_id, pct AS pct_change_last_month FROM newest", *_CHURN_CTES)
CHURN = _with(f"""SELECT user_id, last_d AS last_order_date, ago AS days_since_last_order,
  {_half_up('gsum', 'gcnt', 2)} AS avg_days_between_orders, pct AS pct_change_last_month,
  CASE WHEN ago <= 700 THEN 'Active' ELSE 'At Risk' END AS activity_status
FROM spans LEFT JOIN newest USING (user_id)""", *_CHURN_CTES)

# means of the customers' means: compensated sums of unrounded doubles
_LOYALTY_COLS = """CAST(SUM(spend) AS DOUBLE) / COUNT(spend) AS avg_spend_per_customer,
  CAST(SUM(orders) AS DOUBLE) / COUNT(*) AS avg_repeat_orders, fsum(each) / COUNT(each) AS avg_order_value
FROM (SELECT user_id, is_loyalty, COUNT(DISTINCT order_id) AS orders, SUM(order_total) AS spend,
  CAST(SUM(order_total) AS DOUBLE) / COUNT(order_total) AS each FROM totals_a GROUP BY ALL) GROUP BY is_loyalty"""
LOYALTY = _with("SELECT CASE WHEN is_loyalty THEN '' ELSE 'Non-' END || 'Loyalty Customers' AS customer_type,\n  "
                + _LOYALTY_COLS)
LOYALTY_FLAGGED = _with("SELECT CASE WHEN is_loyalty THEN 'Loyalty Customers' WHEN NOT is_loyalty THEN "
                        "'Non-Loyalty Customers' ELSE 'Non-Loyalty Customers (no flag)' END AS customer_type,\n  "
                        + _LOYALTY_COLS)

DISCOUNTS = _with("""SELECT CASE hd WHEN 1 THEN 'Discounted Order' ELSE 'Non-Discounted Order' END AS order_type,
  COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(t) AS DOUBLE) AS total_revenue,
  CAST(SUM(t) AS DOUBLE) / NULLIF(COUNT(t), 0) AS avg_order_value
FROM (SELECT order_id, SUM(order_total) AS t, MAX(has_discount) AS hd FROM totals_c
      GROUP BY order_id, user_id, restaurant_id) GROUP BY hd""")

_REVENUE_ROWS = ("sold AS (SELECT CAST(creation_time_utc AS DATE) AS d, d - (isodow(d) - 1)::INTEGER AS w, "
                 "make_date(year(d), month(d), 1) AS m, restaurant_id, item_category, item_total "
                 "FROM fact_orders JOIN fact_items USING (order_id))")
SALES_TREND = _with("""SELECT CASE WHEN GROUPING(d) = 0 THEN 'Daily' WHEN GROUPING(w) = 0 THEN 'Weekly' ELSE 'Monthly' END
  AS period_type, CASE WHEN GROUPING(d) = 0 THEN d WHEN GROUPING(w) = 0 THEN w ELSE m END AS period_start,
  restaurant_id, item_category, COALESCE(CAST(SUM(item_total) AS DOUBLE), 0) AS revenue
FROM sold GROUP BY GROUPING SETS ((d, restaurant_id, item_category), (w, restaurant_id, item_category),
  (m, restaurant_id, item_category))""", _REVENUE_ROWS)
REVENUE_BY = {p: f"SELECT * FROM ({SALES_TREND}) WHERE period_type = '{p}'" for p in ("Daily", "Weekly", "Monthly")}

LOCATIONS = _with("""SELECT location_id, CAST(rev AS DOUBLE) AS total_revenue,
  CAST(1 + (SELECT COUNT(*) FROM places b WHERE b.rev > a.rev) AS INTEGER) AS revenue_rank,
  CAST(rev AS DOUBLE) / cnt AS avg_order_value, CAST(orders AS DOUBLE) / NULLIF(days, 0) AS orders_per_day,
  CAST(orders AS DOUBLE) / ((last_d - first_d) // 7 + 1) AS orders_per_week
FROM places a""",
                  """places AS (SELECT restaurant_id AS location_id, COUNT(DISTINCT order_id) AS orders,
  SUM(order_total) AS rev, COUNT(order_total) AS cnt, COUNT(DISTINCT CAST(creation_time_utc AS DATE)) AS days,
  CAST(MIN(creation_time_utc) AS DATE) AS first_d, CAST(MAX(creation_time_utc) AS DATE) AS last_d
  FROM totals_a GROUP BY restaurant_id)""")

DATE_DETAIL = _with("SELECT * FROM date_dim")

PERCENT_RANK = _with("SELECT user_id, CAST(total AS DOUBLE) AS total, PERCENT_RANK() OVER (ORDER BY total) AS percent_rank "
                     "FROM (SELECT user_id, SUM(order_total) AS total FROM totals_a GROUP BY user_id)")
NTILE = _with("SELECT user_id, orders, CAST(NTILE(5) OVER (ORDER BY orders DESC, user_id) AS INTEGER) AS ntile "
              "FROM (SELECT user_id, COUNT(*) AS orders FROM totals_a GROUP BY user_id)")
RUN_REPORTS = " UNION ALL ".join(
    f"SELECT '{name}' AS report, 'SUCCEEDED' AS state, (SELECT COUNT(*) FROM ({sql})) AS rows, 'checked' AS detail"
    for name, sql in {"churn": CHURN, "clv": CLV, "date_detail": DATE_DETAIL, "discounts": DISCOUNTS,
                      "locations": LOCATIONS, "loyalty": LOYALTY, "rfm": RFM_SEGMENTED,
                      "sales_trend": SALES_TREND}.items())

# ----------------------------------------------------------------------------- ETL
_BATCH = f"batch AS (SELECT * FROM order_items WHERE creation_time_utc > {MARK_TS})"
_APPS = ("apps AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY app_name NULLS FIRST) AS INTEGER) AS app_id, app_name "
         "FROM (SELECT DISTINCT app_name FROM order_items))")

CONFORM_ORDERS = _with("SELECT * FROM order_items")
INCREMENTAL_ORDERS = _with("SELECT * FROM batch", _BATCH)
INCREMENTAL_OPTIONS = _with("SELECT * FROM order_item_options x WHERE EXISTS (SELECT 1 FROM batch b "
                            "WHERE b.order_id = x.order_id AND b.lineitem_id = x.lineitem_id)", _BATCH)
DIM_DATE = _with("SELECT * FROM date_dim")
DIM_APP = _with("SELECT * FROM apps", _APPS)
FACT_ORDERS_E8 = _with("SELECT DISTINCT order_id, app_id, restaurant_id, COALESCE(user_id, 'UNKNOWN') AS user_id, "
                       "printed_card_number, is_loyalty, creation_time_utc, currency AS currency_used "
                       "FROM order_items JOIN apps ON order_items.app_name = apps.app_name", _APPS)
FACT_ITEMS_E9 = _with("SELECT * FROM fact_items")
FACT_OPTIONS_E10 = _with("SELECT * FROM fact_items_options")
LANDING_OPTIONS = _with("SELECT order_id, lineitem_id, option_group_name, option_name, "
                        "CAST(option_quantity AS VARCHAR) AS option_quantity, CAST(option_price AS VARCHAR) AS option_price "
                        "FROM order_item_options")
LANDING_DATES = _with("SELECT strftime(date_key, '%d-%m-%Y') AS date_key, CAST(year AS VARCHAR) AS year, is_holiday, "
                      "CAST(week(date_key) AS INTEGER) AS week FROM date_dim")
DATES_E6 = _with("SELECT *, CAST(week(date_key) AS INTEGER) AS week FROM date_dim")
LOAD_LANDING = _with("SELECT order_id, lineitem_id, app_name, restaurant_id, user_id, printed_card_number, is_loyalty, "
                     "strftime(creation_time_utc, '%Y-%m-%dT%H:%M:%S.%gZ') AS creation_time_utc, currency, "
                     "item_category, item_name, CAST(item_quantity AS VARCHAR) AS item_quantity, "
                     "CAST(item_price AS VARCHAR) AS item_price FROM order_items")
# options whose line is among the order lines (all of them, once every batch is loaded)
FACT_OPTIONS_ALL = _with("SELECT * FROM fact_items_options x WHERE EXISTS (SELECT 1 FROM order_items i "
                         "WHERE i.order_id = x.order_id AND i.lineitem_id = x.lineitem_id)")


def _of_items(report: str) -> str:
    """A report over the orders that the ETL loads (those with lines and an app)."""
    return report.replace("raw AS (SELECT * FROM fact_orders", "raw AS (SELECT * FROM (" + (
        "SELECT DISTINCT order_id, restaurant_id, COALESCE(user_id, 'UNKNOWN') AS user_id, printed_card_number, "
        "is_loyalty, creation_time_utc, currency AS currency_used FROM order_items WHERE app_name IS NOT NULL") + ")")


CLV_OF_ITEMS = _of_items(CLV)
# what readers see after a run that died: the lines up to the mark
ITEMS_UP_TO_MARK = _with("SELECT * FROM fact_items f WHERE EXISTS (SELECT 1 FROM order_items i "
                         f"WHERE i.order_id = f.order_id AND i.creation_time_utc <= {MARK_TS})")
ORDERS_UP_TO_MARK = _with("SELECT DISTINCT order_id, app_id, restaurant_id, COALESCE(user_id, 'UNKNOWN') AS user_id, "
                          "printed_card_number, is_loyalty, creation_time_utc, currency AS currency_used "
                          "FROM order_items JOIN apps ON order_items.app_name = apps.app_name "
                          f"WHERE creation_time_utc <= {MARK_TS}",
                          _APPS.replace("FROM order_items", f"FROM order_items WHERE creation_time_utc <= {MARK_TS}"))
DISTINCT_ORDERS = _with("SELECT restaurant_id, COUNT(DISTINCT order_id) AS orders FROM fact_orders WHERE "
                        "CAST(creation_time_utc AS DATE) BETWEEN DATE '2000-06-01' AND DATE '2001-07-01' GROUP BY restaurant_id")
DISTINCT_ORDERS_MONTHLY = _with("SELECT restaurant_id, CAST(date_trunc('month', creation_time_utc) AS DATE) AS month, "
                                "COUNT(DISTINCT order_id) AS orders FROM fact_orders GROUP BY 1, 2")
# rows whose text is spoiled by order number: every 50th, 60th, 70th, 90th
REJECTS = _with("""SELECT 'order_items' AS table_name, order_id, lineitem_id, concat_ws('; ',
  CASE WHEN k % 70 = 0 THEN 'creation_time_utc is not a time' END, CASE WHEN k % 50 = 0 THEN 'item_quantity is not a whole number' END,
  CASE WHEN k % 60 = 0 THEN 'item_price is not a price' END) AS reason
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM order_items) WHERE k % 50 = 0 OR k % 60 = 0 OR k % 70 = 0
UNION ALL SELECT 'order_item_options', order_id, lineitem_id, 'option_price is not a price'
FROM order_item_options WHERE CAST(order_id AS BIGINT) % 90 = 0""")
ITEMS_PARSED = _with("""SELECT * FROM fact_items
WHERE 0 NOT IN (CAST(order_id AS BIGINT) % 50, CAST(order_id AS BIGINT) % 60, CAST(order_id AS BIGINT) % 70)""")
HIGH_WATER_MARK = _with("SELECT MAX(creation_time_utc) AS last_processed_timestamp FROM batch", _BATCH)


# ----------------------------------------------------------------------------- dashboards
def _on(report: str, body: str, *extra: str) -> str:
    ctes = ",\n".join((f"r AS ({report})",) + extra)
    return f"WITH {ctes}\n{body}"


_WEEKLY_ONE = f"SELECT * FROM ({SALES_TREND}) WHERE period_type = 'Weekly' AND restaurant_id = 'NATION_3'"
_MONTHLY = f"SELECT * FROM ({SALES_TREND}) WHERE period_type = 'Monthly'"

DASHBOARDS = {
    "churn_kpis": _on(CHURN, "SELECT COUNT(DISTINCT user_id) AS total_customers, "
                             "COUNT(*) FILTER (WHERE activity_status = 'At Risk') AS at_risk_customers, "
                             f"{_half_up('SUM(days_since_last_order)', 'COUNT(days_since_last_order)', 1)} "
                             "AS avg_days_since_last_order FROM r"),
    "churn_status_counts": _on(CHURN, "SELECT activity_status AS status, COUNT(*) AS customer_count FROM r "
                                      "GROUP BY 1 ORDER BY 2 DESC, 1"),
    "churn_status_fallback": _on(CHURN, "SELECT user_id, last_order_date, days_since_last_order, "
                                        "avg_days_between_orders, pct_change_last_month, "
                                        "CASE WHEN days_since_last_order > 700 THEN 'At Risk' ELSE 'Active' END "
                                        "AS activity_status FROM r"),
    "days_histogram": _on(CHURN, """SELECT bin, CAST(lo AS DOUBLE) + bin * w AS bin_start,
  CAST(lo AS DOUBLE) + (bin + 1) * w AS bin_end, COUNT(*) AS customer_count
FROM (SELECT CASE WHEN w > 0 THEN CAST(LEAST(FLOOR(CAST(days_since_last_order - lo AS DOUBLE) / w), 29) AS INTEGER)
  ELSE 0 END AS bin, lo, w FROM r, hb WHERE days_since_last_order IS NOT NULL)
GROUP BY bin, lo, w ORDER BY bin""",
                          "hb AS (SELECT MIN(days_since_last_order) AS lo, "
                          "CAST(MAX(days_since_last_order) - MIN(days_since_last_order) AS DOUBLE) / 30 AS w FROM r)"),
    "churn_risk_profile": _on(CHURN, "SELECT avg_days_between_orders, days_since_last_order, activity_status, "
                                     "user_id FROM r"),
    "churn_top20": _on(CHURN, "SELECT * FROM r ORDER BY days_since_last_order DESC NULLS LAST, user_id LIMIT 20"),
    "segment_counts": _on(RFM_SEGMENTED, "SELECT customer_segment, COUNT(user_id) AS customer_count FROM r GROUP BY 1"),
    "segment_revenue_share": _on(RFM_SEGMENTED, """SELECT customer_segment, CAST(rev AS DOUBLE) AS total_cost_per_user,
  CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) AS revenue_share
FROM (SELECT customer_segment, SUM(CAST(total_cost_per_user AS DECIMAL(38,4))) AS rev FROM r GROUP BY 1)"""),
    "segment_summary": _on(RFM_SEGMENTED, """SELECT customer_segment,
  CAST(SUM(days_passed) AS DOUBLE) / COUNT(days_passed) AS avg_recency,
  CAST(SUM(num_purchases_last_24_months) AS DOUBLE) / COUNT(num_purchases_last_24_months) AS avg_frequency,
  CAST(SUM(CAST(total_cost_per_user AS DECIMAL(38,4))) AS DOUBLE) / COUNT(total_cost_per_user) AS avg_monetary,
  COUNT(user_id) AS customer_count, """ + _money_sum("total_cost_per_user") + """ AS total_revenue
FROM r GROUP BY 1"""),
    "rfm_scatter": _on(RFM_SEGMENTED, "SELECT days_passed, num_purchases_last_24_months, total_cost_per_user, "
                                      "customer_segment, user_id FROM r"),
    "rfm_sample20": _on(RFM_SEGMENTED, "SELECT * FROM r ORDER BY user_id LIMIT 20"),
    "locations_rounded": _on(LOCATIONS, "SELECT location_id, CAST(ROUND(CAST(total_revenue AS DECIMAL(38,4)), 2) AS DOUBLE) "
                                        f"AS total_revenue, revenue_rank, {_round_double('avg_order_value', 2)} AS avg_order_value, "
                                        f"{_round_double('orders_per_day', 2)} AS orders_per_day, "
                                        f"{_round_double('orders_per_week', 2)} AS orders_per_week FROM r"),
    "top5_locations": _on(LOCATIONS, "SELECT * FROM r ORDER BY total_revenue DESC NULLS LAST, location_id LIMIT 5"),
    "bottom5_locations": _on(LOCATIONS, "SELECT * FROM r ORDER BY total_revenue ASC NULLS LAST, location_id LIMIT 5"),
    "locations_by_metric": _on(LOCATIONS, "SELECT * FROM r ORDER BY orders_per_day DESC NULLS LAST, location_id"),
    "loyalty_table": _on(LOYALTY_FLAGGED, """SELECT metric,
  MAX(CASE WHEN customer_type = 'Loyalty Customers' THEN value END) AS "Loyalty Customers",
  MAX(CASE WHEN customer_type = 'Non-Loyalty Customers' THEN value END) AS "Non-Loyalty Customers",
  MAX(CASE WHEN customer_type = 'Non-Loyalty Customers (no flag)' THEN value END) AS "Non-Loyalty Customers (no flag)"
FROM (
  SELECT customer_type, 'Avg. Spend per Customer ($)' AS metric, """ + _round_double("avg_spend_per_customer", 2) + """ AS value FROM r
  UNION ALL SELECT customer_type, 'Avg. Repeat Orders', """ + _round_double("avg_repeat_orders", 2) + """ FROM r
  UNION ALL SELECT customer_type, 'Avg. Order Value ($)', """ + _round_double("avg_order_value", 2) + """ FROM r
) GROUP BY metric"""),
    "discount_totals": _on(DISCOUNTS, "SELECT " + _money_sum("total_revenue") + " AS total_revenue, "
                                      "CAST(SUM(total_orders) AS BIGINT) AS total_orders, "
                                      "CASE WHEN SUM(total_orders) > 0 THEN " + _money_sum("total_revenue")
                                      + " / CAST(SUM(total_orders) AS DOUBLE) ELSE 0 END AS avg_order_value FROM r"),
    "order_type_share": _on(DISCOUNTS, "SELECT order_type, total_orders, CAST(total_orders AS DOUBLE) / "
                                       "CAST(SUM(total_orders) OVER () AS DOUBLE) AS order_share FROM r"),
    "discount_verdict": _on(DISCOUNTS, """SELECT CAST(d AS DOUBLE) AS discounted_revenue, CAST(n AS DOUBLE) AS non_discounted_revenue,
  d > n AS discounts_drive_revenue FROM (SELECT
  COALESCE(SUM(CASE WHEN order_type = 'Discounted Order' THEN CAST(total_revenue AS DECIMAL(38,4)) END), 0) AS d,
  COALESCE(SUM(CASE WHEN order_type = 'Non-Discounted Order' THEN CAST(total_revenue AS DECIMAL(38,4)) END), 0) AS n
  FROM r)"""),
    "trend_filter": _WEEKLY_ONE,
    "trend_options": _on(SALES_TREND, "SELECT DISTINCT 'period_type' AS selector, period_type AS value FROM r "
                                      "UNION ALL SELECT DISTINCT 'restaurant_id', restaurant_id FROM r "
                                      "UNION ALL SELECT DISTINCT 'item_category', item_category FROM r"),
    "trend_kpis": _on(_MONTHLY, "SELECT " + _money_sum("revenue") + " AS total_revenue, "
                                "COUNT(DISTINCT restaurant_id) AS restaurants, COUNT(DISTINCT item_category) AS categories FROM r"),
    "revenue_over_time": _on(_MONTHLY, "SELECT period_start, " + _money_sum("revenue") + " AS revenue FROM r "
                                       "WHERE period_start IS NOT NULL GROUP BY 1 ORDER BY 1"),
    "holidays_in_range": _with("SELECT date_key FROM date_dim WHERE is_holiday AND date_key BETWEEN "
                               "(SELECT MIN(period_start) FROM wf) AND (SELECT MAX(period_start) FROM wf) ORDER BY 1",
                               f"wf AS ({_WEEKLY_ONE})"),
    "revenue_by_restaurant": _on(_MONTHLY, "SELECT restaurant_id, " + _money_sum("revenue") + " AS revenue FROM r "
                                           "WHERE restaurant_id IS NOT NULL GROUP BY 1"),
    "revenue_by_category": _on(_MONTHLY, """SELECT item_category,
  CASE WHEN LENGTH(item_category) > 20 THEN SUBSTRING(item_category, 1, 20) || '...' ELSE item_category END AS label,
  revenue FROM (SELECT item_category, """ + _money_sum("revenue") + """ AS revenue FROM r
  WHERE item_category IS NOT NULL GROUP BY 1) ORDER BY revenue DESC, item_category"""),
    "trend_latest_first": _on(_WEEKLY_ONE, "SELECT * FROM r ORDER BY period_start DESC NULLS LAST, restaurant_id, item_category"),
    "normalise_period_start": _on(SALES_TREND, "SELECT period_type, CAST(period_start AS TIMESTAMP) AS period_start, "
                                               "restaurant_id, item_category, revenue FROM r"),
}


def oracle_sql() -> dict[str, str]:
    out = {
        "order_totals": _order_totals("totals_a"),
        "order_totals_zero_sum": _order_totals("totals_b"),
        "order_totals_keep_item_null": _order_totals("totals_c"),
        "clv": CLV,
        "rfm_segments": RFM_SEGMENTED,
        "churn_profile": CHURN,
        "avg_order_gap": AVG_GAP,
        "days_since_last_order": RECENCY,
        "monthly_spend_change": MONTHLY_CHANGE,
        "last_month_change": LAST_MONTH_CHANGE,
        "loyalty_impact": LOYALTY,
        "discount_effect": DISCOUNTS,
        "sales_trend": SALES_TREND,
        "daily_revenue": REVENUE_BY["Daily"],
        "weekly_revenue": REVENUE_BY["Weekly"],
        "monthly_revenue": REVENUE_BY["Monthly"],
        "top_locations": LOCATIONS,
        "date_detail": DATE_DETAIL,
        "global_percent_rank": PERCENT_RANK,
        "global_ntile": NTILE,
        "conform_orders": CONFORM_ORDERS,
        "incremental_orders": INCREMENTAL_ORDERS,
        "incremental_options": INCREMENTAL_OPTIONS,
        "dim_date": DIM_DATE,
        "dim_app": DIM_APP,
        "fact_orders": FACT_ORDERS_E8,
        "fact_items": FACT_ITEMS_E9,
        "fact_item_options": FACT_OPTIONS_E10,
        "high_water_mark": HIGH_WATER_MARK,
        "load_landing": LOAD_LANDING,
        "load_landing_options": LANDING_OPTIONS,
        "load_landing_dates": LANDING_DATES,
        "write_curated": FACT_ITEMS_E9,
        "write_curated_orders": FACT_ORDERS_E8,
        "write_bucketed": FACT_ITEMS_E9,
        "run_reports": RUN_REPORTS,
        "run_reports_at_once": RUN_REPORTS,
        "incremental_batch": FACT_ITEMS_E9,
        "incremental_batch_orders": FACT_ORDERS_E8,
        "incremental_batch_options": FACT_OPTIONS_ALL,
        "incremental_batch_apps": DIM_APP,
        "incremental_batch_dates": DATES_E6,
        "incremental_batch_clv": CLV_OF_ITEMS,
        "incremental_stream": FACT_ITEMS_E9,
        "incremental_stream_orders": FACT_ORDERS_E8,
        "incremental_stream_options": FACT_OPTIONS_ALL,
        "incremental_stream_apps": DIM_APP,
        "incremental_stream_dates": DATES_E6,
        "incremental_stream_clv": CLV_OF_ITEMS,
        "batch_killed": ITEMS_UP_TO_MARK,
        "batch_killed_orders": ORDERS_UP_TO_MARK,
        "batch_resumed": FACT_OPTIONS_ALL,
        "batch_resumed_clv": CLV_OF_ITEMS,
        "late_options_batch": FACT_OPTIONS_ALL,
        "late_options_batch_clv": CLV_OF_ITEMS,
        "late_options_stream": FACT_OPTIONS_ALL,
        "distinct_orders": DISTINCT_ORDERS,
        "distinct_orders_monthly": DISTINCT_ORDERS_MONTHLY,
        "rejects": REJECTS,
        "rejects_left_out": ITEMS_PARSED,
        "state_clv": CLV_OF_ITEMS,
        "state_rfm": _of_items(RFM_SEGMENTED),
        "state_churn": _of_items(CHURN),
        "state_loyalty": _of_items(LOYALTY),
        "state_discounts": _of_items(DISCOUNTS),
        "state_locations": _of_items(LOCATIONS),
        "compacted_items": FACT_ITEMS_E9,
        "compacted_options": FACT_OPTIONS_ALL,
        "read_latest_result": LOCATIONS,
    }
    out.update(DASHBOARDS)
    return out
