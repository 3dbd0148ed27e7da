"""Helpers shared by catalog modules: rounding for value hashes, stand-in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns (both engines round the same way away
    from ties; summation order only moves far digits)."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# DuckDB twin of featuremart.sources.standins, as CTEs: the raw mapping to
# src_customers / src_sessions / src_events / src_orders, then the cleaning
# into c_sessions / c_events / c_orders. Any oracle that needs the four
# source tables starts with STANDIN_CTES.
RAW_CTES = """
ev_map AS (
  SELECT event_id,
         user_id * 1000 + dayofyear(ts) AS session_id,
         ts AS "timestamp",
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'error' THEN NULL ELSE json_extract_string(props, '$.k') END AS product_id,
         user_id
  FROM events
),
src_events AS (
  SELECT event_id, session_id, "timestamp", event_type, product_id FROM ev_map
  UNION ALL
  SELECT event_id, session_id, "timestamp", event_type, product_id FROM ev_map WHERE event_id % 50 = 0
),
src_sessions AS (
  SELECT session_id, min(user_id) AS customer_id, min("timestamp") AS start_time FROM ev_map GROUP BY session_id
),
src_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         o_orderdate + INTERVAL 8217 DAY + CAST(o_orderkey % 1440 AS BIGINT) * INTERVAL 1 MINUTE AS order_time,
         CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_usd
  FROM orders
),
src_customers AS (SELECT c_custkey AS customer_id FROM customer)
"""

CLEAN_CTES = """
c_events AS (
  SELECT event_id, session_id, "timestamp", event_type, product_id FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "timestamp" NULLS FIRST, session_id NULLS FIRST,
                                 event_type NULLS FIRST, product_id NULLS FIRST) AS rn
    FROM src_events)
  WHERE rn = 1 AND product_id IS NOT NULL AND "timestamp" < TIMESTAMP '2024-01-25 00:00:00'
),
c_sessions AS (
  SELECT session_id, customer_id, start_time FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_time NULLS FIRST, customer_id NULLS FIRST) AS rn
    FROM src_sessions)
  WHERE rn = 1 AND start_time < TIMESTAMP '2024-01-25 00:00:00'
),
c_orders AS (
  SELECT order_id, customer_id, order_time, total_usd FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_time NULLS FIRST, customer_id NULLS FIRST,
                                 total_usd NULLS FIRST) AS rn
    FROM src_orders)
  WHERE rn = 1 AND order_time < TIMESTAMP '2024-01-25 00:00:00'
)
"""

STANDIN_CTES = RAW_CTES.rstrip().rstrip('"') + ",\n" + CLEAN_CTES.strip() + "\n"

# Feature CTEs in DuckDB over c_events / c_sessions / c_orders (run date
# 2024-01-25: 7-day bound 2024-01-18, 30-day bound 2023-12-26).
FEATURE_CTES = """
ev_attr AS (
  SELECT e.*, s.customer_id
  FROM c_events e JOIN c_sessions s ON e.session_id IS NOT DISTINCT FROM s.session_id
  WHERE s.customer_id IS NOT NULL
),
ev_feat AS (
  SELECT customer_id,
    count(*) FILTER (WHERE event_type = 'page_view' AND "timestamp" >= TIMESTAMP '2024-01-18') AS page_view_7,
    count(*) FILTER (WHERE event_type = 'add_to_cart' AND "timestamp" >= TIMESTAMP '2024-01-18') AS add_to_cart_7,
    count(*) FILTER (WHERE event_type = 'purchase' AND "timestamp" >= TIMESTAMP '2024-01-18') AS purchase_7,
    count(DISTINCT product_id) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-18') AS unique_products_7,
    count(*) FILTER (WHERE event_type = 'page_view') AS page_view_30,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart_30,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase_30,
    count(DISTINCT product_id) AS unique_products_30
  FROM ev_attr WHERE "timestamp" >= TIMESTAMP '2023-12-26'
  GROUP BY customer_id
),
spans AS (
  SELECT session_id, min("timestamp") AS session_start, max("timestamp") AS session_end
  FROM c_events GROUP BY session_id
),
sess_len AS (
  SELECT s.session_id, s.customer_id, s.start_time, p.session_start, p.session_end,
         coalesce(date_diff('microsecond', p.session_start, p.session_end) / 1e6, 0.0) AS duration_seconds
  FROM c_sessions s LEFT JOIN spans p ON s.session_id = p.session_id
),
sess_feat AS (
  SELECT customer_id,
    avg(duration_seconds) FILTER (WHERE start_time >= TIMESTAMP '2023-12-26') AS avg_session_length_30,
    count(*) FILTER (WHERE start_time >= TIMESTAMP '2024-01-18') AS sessions_7,
    count(*) FILTER (WHERE start_time >= TIMESTAMP '2023-12-26') AS sessions_30
  FROM sess_len WHERE customer_id IS NOT NULL
  GROUP BY customer_id
),
ord_feat AS (
  SELECT customer_id,
    date_sub('day', max(order_time), TIMESTAMP '2024-01-25') AS days_since_last_purchase,
    count(*) FILTER (WHERE order_time >= TIMESTAMP '2023-12-26') AS orders_30,
    sum(coalesce(TRY_CAST(total_usd AS DOUBLE), 0.0)) FILTER (WHERE order_time >= TIMESTAMP '2023-12-26') AS sum_total_usd_30,
    avg(coalesce(TRY_CAST(total_usd AS DOUBLE), 0.0)) FILTER (WHERE order_time >= TIMESTAMP '2023-12-26') AS avg_total_usd_30
  FROM c_orders WHERE customer_id IS NOT NULL
  GROUP BY customer_id
),
wide AS (
  SELECT sp.customer_id, ev.page_view_7, ev.add_to_cart_7, ev.purchase_7, ev.unique_products_7,
         ev.page_view_30, ev.add_to_cart_30, ev.purchase_30, ev.unique_products_30,
         ss.avg_session_length_30, ss.sessions_7, ss.sessions_30,
         od.days_since_last_purchase, od.orders_30, od.sum_total_usd_30, od.avg_total_usd_30
  FROM (SELECT DISTINCT customer_id FROM src_customers) sp
  LEFT JOIN ev_feat ev ON sp.customer_id = ev.customer_id
  LEFT JOIN sess_feat ss ON sp.customer_id = ss.customer_id
  LEFT JOIN ord_feat od ON sp.customer_id = od.customer_id
),
features AS (
  SELECT customer_id,
    CAST(coalesce(page_view_7, 0) AS BIGINT) AS page_view_7,
    CAST(coalesce(add_to_cart_7, 0) AS BIGINT) AS add_to_cart_7,
    CAST(coalesce(purchase_7, 0) AS BIGINT) AS purchase_7,
    CAST(coalesce(unique_products_7, 0) AS BIGINT) AS unique_products_7,
    CAST(coalesce(page_view_30, 0) AS BIGINT) AS page_view_30,
    CAST(coalesce(add_to_cart_30, 0) AS BIGINT) AS add_to_cart_30,
    CAST(coalesce(purchase_30, 0) AS BIGINT) AS purchase_30,
    CAST(coalesce(unique_products_30, 0) AS BIGINT) AS unique_products_30,
    coalesce(avg_session_length_30, 0.0) AS avg_session_length_30,
    CAST(coalesce(sessions_7, 0) AS BIGINT) AS sessions_7,
    CAST(coalesce(sessions_30, 0) AS BIGINT) AS sessions_30,
    CAST(coalesce(days_since_last_purchase, -1) AS BIGINT) AS days_since_last_purchase,
    CAST(coalesce(orders_30, 0) AS BIGINT) AS orders_30,
    coalesce(sum_total_usd_30, 0.0) AS sum_total_usd_30,
    coalesce(avg_total_usd_30, 0.0) AS avg_total_usd_30,
    CASE WHEN page_view_7 > 0 AND add_to_cart_7 > 0 THEN CAST(add_to_cart_7 AS DOUBLE) / page_view_7 END AS conversion_page_to_cart_7,
    CASE WHEN page_view_30 > 0 AND add_to_cart_30 > 0 THEN CAST(add_to_cart_30 AS DOUBLE) / page_view_30 END AS conversion_page_to_cart_30,
    CASE WHEN add_to_cart_7 > 0 AND purchase_7 > 0 THEN CAST(purchase_7 AS DOUBLE) / add_to_cart_7 END AS conversion_cart_to_purchase_7,
    CASE WHEN add_to_cart_30 > 0 AND purchase_30 > 0 THEN CAST(purchase_30 AS DOUBLE) / add_to_cart_30 END AS conversion_cart_to_purchase_30,
    TIMESTAMP '2024-01-25 00:00:00' AS run_date
  FROM wide
)
"""


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select
