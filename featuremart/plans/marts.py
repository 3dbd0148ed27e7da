"""Marketplace mart and ad-hoc analyses over users, orders and payments.

Inputs (any source, these column names):

* ``users(user_id, region)``
* ``orders(order_id, user_id, order_time, amount)``
* ``payments(order_id, paid)``
* ``ratings(order_id, rating)``, optional

Every fact is aggregated to its key before it is joined, so no join fans
out rows of one fact against another. Money should arrive as a decimal:
sums are then exact in any order and every mean is ``double(sum) / count``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Order-count segments (lower bound, label), ascending.
SEGMENTS: tuple[tuple[int, str], ...] = ((1, "1"), (2, "2-5"), (6, "6-10"), (11, "11+"))


def user_mart(users: DataFrame, orders: DataFrame, payments: DataFrame, ratings: DataFrame | None = None) -> DataFrame:
    """One row per user: order, payment and rating aggregates (zeros when none;
    the mean rating is NULL then)."""
    per_order_pay = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_payments"), F.sum("paid").alias("paid")
    )
    per_order = orders.join(per_order_pay, "order_id", "left")
    rated = []
    if ratings is not None:
        per_order_rating = ratings.groupBy("order_id").agg(
            F.count("rating").alias("_ratings"), F.sum("rating").alias("_stars")
        )
        per_order = per_order.join(per_order_rating, "order_id", "left")
        rated = [
            F.coalesce(F.sum("_ratings"), F.lit(0)).alias("n_ratings"),
            (F.sum("_stars").cast("double") / F.sum("_ratings")).alias("avg_rating"),
        ]
    per_user = per_order.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("amount").alias("revenue"),
        (F.sum("amount").cast("double") / F.count(F.lit(1))).alias("avg_check"),
        F.min("order_time").alias("first_order"),
        F.max("order_time").alias("last_order"),
        F.sum("n_payments").alias("n_payments"),
        F.sum("paid").alias("paid"),
        *rated,
    )
    out = users.select("user_id", "region").join(per_user, "user_id", "left")
    return out.withColumns(
        {
            "n_orders": F.coalesce("n_orders", F.lit(0)),
            "n_payments": F.coalesce("n_payments", F.lit(0)),
            "revenue": F.coalesce("revenue", F.lit(0)),
            "paid": F.coalesce("paid", F.lit(0)),
        }
        | ({"n_ratings": F.coalesce("n_ratings", F.lit(0))} if ratings is not None else {})
    )


def segment_label(n_orders: str = "n_orders"):
    expr = None
    for lower, label in reversed(SEGMENTS):
        cond = F.col(n_orders) >= lower
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def order_segments(mart: DataFrame) -> DataFrame:
    """Users with at least one order, by order-count segment."""
    buyers = mart.where(F.col("n_orders") > 0).withColumn("segment", segment_label())
    return buyers.groupBy("segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("n_orders").alias("avg_orders"),
        (F.sum("revenue").cast("double") / F.sum("n_orders")).alias("avg_check"),
    )


def top_regions(mart: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` regions with the most revenue (ties by region name)."""
    per_region = mart.where(F.col("n_orders") > 0).groupBy("region").agg(
        F.sum("n_orders").alias("orders"),
        F.count(F.lit(1)).alias("users"),
        F.sum("revenue").alias("revenue"),
        (F.sum("revenue").cast("double") / F.sum("n_orders")).alias("avg_check"),
    )
    return per_region.orderBy(F.desc("revenue"), F.asc("region")).limit(k)


def cohorts(orders: DataFrame, year: int) -> DataFrame:
    """Monthly cohorts of ``year``: cohort = month of a user's first order ever.

    Per user one aggregate gives the first order and the set of active
    months inside the year (at most 12, so the set is bounded).
    """
    month = F.trunc("order_time", "month")
    in_year = F.year("order_time") == year
    per_user = orders.groupBy("user_id").agg(
        F.min("order_time").alias("first_time"),
        F.collect_set(F.when(in_year, month)).alias("months"),
    )
    cohort_users = per_user.withColumn("cohort_month", F.trunc("first_time", "month")).where(
        F.year("cohort_month") == year
    )
    active = cohort_users.select("user_id", "cohort_month", F.explode("months").alias("month")).where(
        F.col("month") >= F.col("cohort_month")
    )
    cells = active.groupBy("cohort_month", "month").agg(F.count(F.lit(1)).alias("users"))
    cells = cells.withColumn("month_offset", F.months_between("month", "cohort_month").cast("int"))
    size = F.max(F.when(F.col("month_offset") == 0, F.col("users"))).over(Window.partitionBy("cohort_month"))
    return cells.withColumn("cohort_size", size).select(
        "cohort_month",
        "month_offset",
        "users",
        "cohort_size",
        (F.col("users") / F.col("cohort_size")).alias("retention"),
    )


def user_ltv(orders: DataFrame) -> DataFrame:
    """Per user: lifetime value, orders, average check, active months."""
    return orders.groupBy("user_id").agg(
        F.sum("amount").alias("ltv"),
        F.count(F.lit(1)).alias("n_orders"),
        (F.sum("amount").cast("double") / F.count(F.lit(1))).alias("avg_check"),
        F.count_distinct(F.trunc("order_time", "month")).alias("active_months"),
    )


def ltv_by_repeat(orders: DataFrame) -> DataFrame:
    """LTV and behaviour of one-time against repeat buyers."""
    per_user = user_ltv(orders).withColumn("is_repeat", F.col("n_orders") > 1)
    return per_user.groupBy("is_repeat").agg(
        F.count(F.lit(1)).alias("users"),
        (F.sum("ltv").cast("double") / F.count(F.lit(1))).alias("avg_ltv"),
        (F.sum("ltv").cast("double") / F.sum("n_orders")).alias("avg_check"),
        F.avg(F.col("n_orders") / F.col("active_months")).alias("orders_per_active_month"),
    )


TOP_USERS_SQL = """
WITH user_revenue AS (
  SELECT user_id, sum(amount) AS revenue
  FROM {orders}
  GROUP BY user_id
),
ranked AS (
  SELECT u.region, r.user_id, r.revenue,
         row_number() OVER (PARTITION BY u.region ORDER BY r.revenue DESC, r.user_id) AS rnk
  FROM user_revenue r JOIN {users} u ON r.user_id = u.user_id
)
SELECT region, user_id, revenue, rnk FROM ranked WHERE rnk <= {k}
"""


def top_users_per_region(spark: SparkSession, users_view: str, orders_view: str, k: int = 3) -> DataFrame:
    """CTE + window rank in Spark SQL over registered views.

    ``rnk <= k`` lets Spark put a partial group limit before the shuffle, so
    each region sends at most k rows per map task.
    """
    return spark.sql(TOP_USERS_SQL.format(users=users_view, orders=orders_view, k=int(k)))
