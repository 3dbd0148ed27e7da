"""Weekly store/department sales stand-ins.

store = supplier, department = part brand, weekly sales = discounted line
revenue by ship week (exact decimal); per-(store, week) features come from
the same lines; stores carry their nation and region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.standins import table

MONEY = "decimal(18,2)"


def _week(c: str):
    return F.date_trunc("week", F.col(c)).cast("timestamp_ntz")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    revenue = F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return j.groupBy(
        F.col("l_suppkey").alias("store_id"), F.col("p_brand").alias("dept"), _week("l_shipdate").alias("week")
    ).agg(F.sum(revenue).alias("sales"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return s.join(geo, s.s_nationkey == geo.n_nationkey, "left").select(
        F.col("s_suppkey").alias("store_id"), F.col("n_name").alias("store_nation"), F.col("r_name").alias("store_region")
    )


def store_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("store_id"), _week("l_shipdate").alias("week")).agg(
        F.count(F.lit(1)).alias("store_lines"),
        (F.sum(F.col("l_discount").cast("decimal(4,2)")).cast("double") / F.count(F.lit(1))).alias("avg_discount"),
    )


SQL_CTES = """
f_sales AS (
  SELECT l.l_suppkey AS store_id, p.p_brand AS dept, date_trunc('week', l.l_shipdate) AS week,
         sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS sales
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_suppkey, p.p_brand, date_trunc('week', l.l_shipdate)
),
f_stores AS (
  SELECT s.s_suppkey AS store_id, n.n_name AS store_nation, r.r_name AS store_region
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
f_feat AS (
  SELECT l_suppkey AS store_id, date_trunc('week', l_shipdate) AS week, count(*) AS store_lines,
         CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS avg_discount
  FROM lineitem GROUP BY l_suppkey, date_trunc('week', l_shipdate)
),
f_plan AS (
  SELECT store_id, dept, week, sales, false AS is_plan FROM f_sales
  UNION ALL
  SELECT p.store_id, p.dept, (SELECT max(week) FROM f_sales) + t.k * INTERVAL 7 DAY AS week, NULL AS sales, true AS is_plan
  FROM (SELECT DISTINCT store_id, dept FROM f_sales) p, range(1, 5) t(k)
),
f_idx AS (SELECT *, date_diff('day', DATE '1970-01-05', CAST(week AS DATE)) // 7 AS widx FROM f_plan),
f_lags AS (
  SELECT store_id, dept, week, sales, is_plan,
    CAST(sum(sales) OVER (PARTITION BY store_id, dept ORDER BY widx RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS lag_1,
    CAST(sum(sales) OVER (PARTITION BY store_id, dept ORDER BY widx RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS DOUBLE) AS lag_2,
    CAST(sum(sales) OVER (PARTITION BY store_id, dept ORDER BY widx RANGE BETWEEN 3 PRECEDING AND 3 PRECEDING) AS DOUBLE) AS lag_3,
    CAST(sum(sales) OVER (PARTITION BY store_id, dept ORDER BY widx RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING) AS DOUBLE) AS lag_4,
    CAST(sum(sales) OVER w4 AS DOUBLE) / NULLIF(count(sales) OVER w4, 0) AS rolling_mean_4
  FROM f_idx
  WINDOW w4 AS (PARTITION BY store_id, dept ORDER BY widx RANGE BETWEEN 4 PRECEDING AND 1 PRECEDING)
),
f_fc AS (
  SELECT *, 2.0 * lag_1 - lag_2 AS raw_forecast, greatest(2.0 * lag_1 - lag_2, 0.0) AS forecast
  FROM f_lags WHERE NOT is_plan
)
"""
