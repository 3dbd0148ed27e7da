"""Checks for the marketplace mart (prose-described analyses)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.plans import marts
from featuremart.sources import marketplace as mk
from featuremart.sources.marketplace import SQL_CTES

COHORT_YEAR = 1995
M = 9  # digits for means of non-money doubles


def _mart(spark, sf_dir):
    return marts.user_mart(mk.users(spark, sf_dir), mk.orders(spark, sf_dir), mk.payments(spark, sf_dir), mk.ratings(spark, sf_dir))


def as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


MART_CTES = with_ctes(
    SQL_CTES,
    """pay AS (SELECT order_id, count(*) AS n_payments, sum(paid) AS paid FROM m_payments GROUP BY order_id),
rat AS (SELECT order_id, count(rating) AS n_ratings, sum(rating) AS stars FROM m_ratings GROUP BY order_id),
per_user AS (
  SELECT o.user_id, CAST(coalesce(sum(r.n_ratings), 0) AS BIGINT) AS n_ratings, CAST(sum(r.stars) AS DOUBLE) / sum(r.n_ratings) AS avg_rating, count(*) AS n_orders, sum(amount) AS revenue, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_check,
         min(order_time) AS first_order, max(order_time) AS last_order,
         CAST(sum(p.n_payments) AS BIGINT) AS n_payments, sum(p.paid) AS paid
  FROM m_orders o LEFT JOIN pay p ON o.order_id = p.order_id LEFT JOIN rat r ON o.order_id = r.order_id GROUP BY o.user_id
),
mart AS (
  SELECT u.user_id, u.region, coalesce(n_orders, 0) AS n_orders, coalesce(revenue, 0) AS revenue, avg_check,
         first_order, last_order, coalesce(n_payments, 0) AS n_payments, coalesce(paid, 0) AS paid, coalesce(n_ratings, 0) AS n_ratings, avg_rating
  FROM m_users u LEFT JOIN per_user p ON u.user_id = p.user_id
)""",
    select="",
).rstrip() + "\n"


@register(
    "user_mart",
    MART_CTES
    + """SELECT user_id, region, n_orders, CAST(revenue AS DOUBLE) AS revenue, avg_check,
       first_order, last_order, n_payments, CAST(paid AS DOUBLE) AS paid, n_ratings, avg_rating FROM mart""",
)
def user_mart(spark, sf_dir):
    return as_double(_mart(spark, sf_dir), "revenue", "paid")


@register(
    "order_segments",
    MART_CTES
    + """SELECT segment, count(*) AS users, round(avg(n_orders), 9) AS avg_orders,
       CAST(sum(revenue) AS DOUBLE) / sum(n_orders) AS avg_check
FROM (SELECT *, CASE WHEN n_orders >= 11 THEN '11+' WHEN n_orders >= 6 THEN '6-10'
                     WHEN n_orders >= 2 THEN '2-5' ELSE '1' END AS segment
      FROM mart WHERE n_orders > 0) GROUP BY segment""",
)
def order_segments(spark, sf_dir):
    return rounded(marts.order_segments(_mart(spark, sf_dir)), {"avg_orders": M})


@register(
    "top_regions",
    MART_CTES
    + """SELECT region, CAST(sum(n_orders) AS BIGINT) AS orders, count(*) AS users, CAST(sum(revenue) AS DOUBLE) AS revenue,
       CAST(sum(revenue) AS DOUBLE) / sum(n_orders) AS avg_check
FROM mart WHERE n_orders > 0 GROUP BY region ORDER BY sum(revenue) DESC, region LIMIT 3""",
)
def top_regions(spark, sf_dir):
    return as_double(marts.top_regions(_mart(spark, sf_dir)), "revenue")


@register(
    "cohorts",
    with_ctes(
        SQL_CTES,
        f"""firsts AS (SELECT user_id, date_trunc('month', min(order_time)) AS cohort_month FROM m_orders GROUP BY user_id),
act AS (SELECT DISTINCT user_id, date_trunc('month', order_time) AS month FROM m_orders WHERE year(order_time) = {COHORT_YEAR}),
cells AS (
  SELECT f.cohort_month, a.month, count(*) AS users
  FROM firsts f JOIN act a ON f.user_id = a.user_id
  WHERE year(f.cohort_month) = {COHORT_YEAR} AND a.month >= f.cohort_month
  GROUP BY f.cohort_month, a.month
)""",
        select="""SELECT strftime(cohort_month, '%Y-%m') AS cohort_month,
       CAST(date_diff('month', cohort_month, month) AS INTEGER) AS month_offset,
       users, max(CASE WHEN month = cohort_month THEN users END) OVER (PARTITION BY cohort_month) AS cohort_size,
       round(users / max(CASE WHEN month = cohort_month THEN users END) OVER (PARTITION BY cohort_month), 9) AS retention
FROM cells""",
    ),
)
def cohorts(spark, sf_dir):
    out = marts.cohorts(mk.orders(spark, sf_dir), COHORT_YEAR)
    out = out.withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM"))
    return rounded(out, {"retention": M})


@register(
    "ltv",
    with_ctes(
        SQL_CTES,
        """per_user AS (
  SELECT user_id, sum(amount) AS ltv, count(*) AS n_orders,
         count(DISTINCT date_trunc('month', order_time)) AS active_months
  FROM m_orders GROUP BY user_id
)""",
        select="""SELECT n_orders > 1 AS is_repeat, count(*) AS users, CAST(sum(ltv) AS DOUBLE) / count(*) AS avg_ltv,
       CAST(sum(ltv) AS DOUBLE) / sum(n_orders) AS avg_check,
       round(avg(n_orders / active_months), 9) AS orders_per_active_month
FROM per_user GROUP BY n_orders > 1""",
    ),
)
def ltv(spark, sf_dir):
    return rounded(marts.ltv_by_repeat(mk.orders(spark, sf_dir)), {"orders_per_active_month": M})


@register(
    "cte_rank",
    with_ctes(
        SQL_CTES,
        """user_revenue AS (SELECT user_id, sum(amount) AS revenue FROM m_orders GROUP BY user_id),
ranked AS (
  SELECT u.region, r.user_id, r.revenue,
         row_number() OVER (PARTITION BY u.region ORDER BY r.revenue DESC, r.user_id) AS rnk
  FROM user_revenue r JOIN m_users u ON r.user_id = u.user_id
)""",
        select="SELECT region, user_id, CAST(revenue AS DOUBLE) AS revenue, rnk FROM ranked WHERE rnk <= 3",
    ),
)
def cte_rank(spark, sf_dir):
    mk.users(spark, sf_dir).createOrReplaceTempView("mk_users")
    mk.orders(spark, sf_dir).createOrReplaceTempView("mk_orders")
    return as_double(marts.top_users_per_region(spark, "mk_users", "mk_orders", 3), "revenue")
