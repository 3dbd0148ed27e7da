"""Marketplace stand-ins over the TPC-H-like tables.

users = customers with their region; orders = orders; payments = order lines
(discounted price)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.standins import table

MONEY = "decimal(18,2)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_time"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("paid"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rating per order line: 5 kept, 3 accepted, 1 returned."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.when(flag == "R", 1).when(flag == "A", 3).otherwise(5).alias("rating")
    )


SQL_CTES = """
m_users AS (
  SELECT c.c_custkey AS user_id, r.r_name AS region
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
m_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_time, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
),
m_payments AS (
  SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS paid FROM lineitem
),
m_ratings AS (
  SELECT l_orderkey AS order_id, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 3 ELSE 5 END AS rating FROM lineitem
)
"""
