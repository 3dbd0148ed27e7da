"""Hotel-booking stand-ins: orders → bookings, documents → reviews.

A booking's stay is its number of order lines (nights; an order without lines
has none and score 0), its price the order total, it is cancelled when the order status is ``P``, and its score is the
share of returned lines on a 1/20 grid (integer arithmetic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.standins import table

GRID = 20


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
    )
    j = o.join(lines, "o_orderkey", "left")
    return j.select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("arrival"),
        F.coalesce("lines", F.lit(0)).cast("int").alias("stay_nights"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        (F.col("o_orderstatus") == "P").alias("is_canceled"),
        F.coalesce(F.col("returned") * GRID / F.col("lines"), F.lit(0)).cast("int").alias("score_bucket"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


SQL_CTES = """
h_lines AS (
  SELECT l_orderkey, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
  FROM lineitem GROUP BY l_orderkey
),
h_book AS (
  SELECT o.o_orderkey AS booking_id, o.o_custkey AS customer_id, o.o_orderdate AS arrival,
         CAST(coalesce(h.lines, 0) AS INTEGER) AS stay_nights, CAST(o.o_totalprice AS DECIMAL(18,2)) AS price,
         o.o_orderstatus = 'P' AS is_canceled, CAST(coalesce((h.returned * 20) // h.lines, 0) AS INTEGER) AS score_bucket
  FROM orders o LEFT JOIN h_lines h ON o.o_orderkey = h.l_orderkey
)
"""
