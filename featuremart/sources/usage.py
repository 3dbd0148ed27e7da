"""Behaviour stand-ins: events → site visits (event type as site category,
value as depth), customers with region and market segment (the class label),
orders and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.standins import table

# The site categories of the test events.
CATEGORIES: tuple[str, ...] = ("view", "click", "purchase", "signup", "error")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "ts", F.col("event_type").alias("category"), "value"
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("r_name").alias("region"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity")
    )


def device_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as device sessions: the id as user, the source as device, the
    length as seconds."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("user_id"), F.col("source").alias("device"), F.col("n_chars").alias("seconds")
    )


def ad_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ads seen: the id as user, the host as site, the page's length as size."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("long").alias("user_id"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("site"),
        F.length("html").cast("long").alias("size"),
    )


def cloud_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as cloud operations: conversation as user, role as operation."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("user_id"), F.col("role").alias("operation"), F.length("text").cast("long").alias("bytes")
    )


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels with a length-rule prediction (long texts predicted good)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id", "inner").select(
        "doc_id", F.col("quality").alias("label"), (F.col("n_chars") >= 1000).cast("int").alias("prediction")
    )


SQL_CTES = """
u_visits AS (SELECT user_id, ts, event_type AS category, value FROM events),
u_users AS (
  SELECT c.c_custkey AS user_id, r.r_name AS region, c.c_acctbal AS acctbal, c.c_mktsegment AS segment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
u_stats AS (
  SELECT user_id, count(*) AS visits, avg(value) AS avg_value, stddev_samp(value) AS std_value,
         min(value) AS min_value, max(value) AS max_value, count(DISTINCT category) AS n_categories,
         min(ts) AS first_visit, max(ts) AS last_visit
  FROM u_visits GROUP BY user_id
),
u_shares AS (
  SELECT user_id,
         count(*) FILTER (WHERE category = 'view') / count(*) AS share_view,
         count(*) FILTER (WHERE category = 'click') / count(*) AS share_click,
         count(*) FILTER (WHERE category = 'purchase') / count(*) AS share_purchase,
         count(*) FILTER (WHERE category = 'signup') / count(*) AS share_signup,
         count(*) FILTER (WHERE category = 'error') / count(*) AS share_error
  FROM u_visits GROUP BY user_id
),
u_orders AS (
  SELECT o.o_custkey AS user_id, count(*) AS n_orders, sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS order_amount,
         CAST(coalesce(sum(l.lines), 0) AS BIGINT) AS n_lines, sum(l.qty) AS quantity
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, count(*) AS lines, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY l_orderkey
  ) l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey
),
u_device AS (
  SELECT doc_id AS user_id, count(*) AS device_sessions, CAST(sum(n_chars) AS BIGINT) AS device_seconds, count(DISTINCT source) AS n_devices
  FROM documents GROUP BY doc_id
),
u_ads AS (
  SELECT CAST(page_id AS BIGINT) AS user_id, count(*) AS ad_views, CAST(sum(length(html)) AS BIGINT) AS ad_size,
         count(DISTINCT regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS n_ad_sites
  FROM pages GROUP BY page_id
),
u_cloud AS (
  SELECT CAST(conv_id AS BIGINT) AS user_id, count(*) AS cloud_operations, CAST(sum(length(text)) AS BIGINT) AS cloud_bytes,
         count(DISTINCT role) AS n_cloud_kinds
  FROM conversations GROUP BY conv_id
)
"""
