"""Ticket-order stand-ins for the loyalty analysis.

orders → ticket orders; priority → genre and currency (the lowest priority
is paid in KZT), status → device, customer region and market segment →
region and service. Daily KZT rates are generated over the orders' own date
range, so the table grows with the data's calendar, not with its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.standins import table

# Fixed values of the stand-in.
FOREIGN_CURRENCY = "KZT"
FOREIGN_PRIORITY = "5-LOW"
KZT_NOMINAL = 100


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "r_name")
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select("c_custkey", "r_name", "c_mktsegment")
    j = o.join(cust, o.o_custkey == cust.c_custkey, "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_time"),
        F.when(F.col("o_orderpriority") == FOREIGN_PRIORITY, F.lit(FOREIGN_CURRENCY)).otherwise(F.lit("RUB")).alias(
            "currency"
        ),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("device"),
        F.col("o_orderpriority").alias("genre"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("service"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    span = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("rate_date"))
    return days.select(
        F.lit(FOREIGN_CURRENCY).alias("currency"),
        "rate_date",
        ((F.lit(180) + F.dayofyear("rate_date") % 10).cast("decimal(4,0)") / 10).cast("decimal(3,1)").alias("rate"),
        F.lit(KZT_NOMINAL).alias("nominal"),
    )


SQL_CTES = """
t_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, o.o_orderdate AS order_time,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'KZT' ELSE 'RUB' END AS currency,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount, o.o_orderstatus AS device, o.o_orderpriority AS genre,
         r.r_name AS region, c.c_mktsegment AS service
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
t_fx AS (
  SELECT *, CASE WHEN currency = 'RUB' THEN amount
                 ELSE amount * CAST(18 + (dayofyear(order_time) % 10) * 0.1 AS DECIMAL(3,1)) * 0.01 END AS revenue_rub
  FROM t_orders
),
t_gaps AS (
  SELECT *, lag(order_time) OVER (PARTITION BY user_id ORDER BY order_time, order_id) AS prev_order_time
  FROM t_fx
),
t_gaps2 AS (SELECT *, date_diff('day', prev_order_time, order_time) AS gap_days FROM t_gaps),
t_profile AS (
  SELECT user_id, min(order_time) AS first_order, max(order_time) AS last_order, count(*) AS n_orders,
         sum(revenue_rub) AS revenue_rub, CAST(sum(revenue_rub) AS DOUBLE) / count(*) AS avg_revenue_rub,
         first(device ORDER BY order_time, order_id) AS first_device,
         first(genre ORDER BY order_time, order_id) AS first_genre,
         first(region ORDER BY order_time, order_id) AS first_region,
         first(service ORDER BY order_time, order_id) AS first_service,
         last(device ORDER BY order_time, order_id) AS last_device, last(genre ORDER BY order_time, order_id) AS last_genre,
         last(region ORDER BY order_time, order_id) AS last_region, last(service ORDER BY order_time, order_id) AS last_service,
         last(revenue_rub ORDER BY order_time, order_id) AS last_revenue_rub, min(revenue_rub) AS min_revenue_rub,
         max(revenue_rub) AS max_revenue_rub, date_diff('day', min(order_time), max(order_time)) AS span_days,
         count(DISTINCT region) AS n_regions, count(DISTINCT service) AS n_services,
         count(DISTINCT month(order_time)) AS n_months, max(gap_days) AS max_gap_days,
         count(*) FILTER (WHERE dayofweek(order_time) IN (0, 6)) / count(*) AS weekend_share,
         count(DISTINCT genre) AS n_genres, count(DISTINCT device) AS n_devices,
         avg(gap_days) AS avg_gap_days, count(*) >= 2 AS is_two, count(*) >= 5 AS is_five
  FROM t_gaps2 GROUP BY user_id
)
"""
