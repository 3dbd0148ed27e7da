"""Checks for the weekly sales forecast features (prose-described)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.plans import forecast as fc
from featuremart.sources import sales as sl
from featuremart.sources.sales import SQL_CTES

CURRENT_FROM = "2000-01-01"
PSI_FEATURES = ("sales", "lag_1", "rolling_mean_4")
HOLIDAY_LIST = ", ".join(f"'{h}'" for h in fc.HOLIDAYS)


def _history(spark, sf_dir):
    return sl.sales(spark, sf_dir)


def _lags(spark, sf_dir):
    return fc.lag_features(fc.with_plan(_history(spark, sf_dir)))


@register(
    "sales_panel",
    with_ctes(
        SQL_CTES,
        select="""SELECT s.store_id, s.dept, s.week, CAST(s.sales AS DOUBLE) AS sales, st.store_nation, st.store_region,
       f.store_lines, f.avg_discount
FROM f_sales s LEFT JOIN f_stores st ON s.store_id = st.store_id
LEFT JOIN f_feat f ON s.store_id = f.store_id AND s.week = f.week""",
    ),
)
def sales_panel(spark, sf_dir):
    p = fc.sales_panel(_history(spark, sf_dir), sl.stores(spark, sf_dir), sl.store_features(spark, sf_dir))
    return p.withColumn("sales", F.col("sales").cast("double"))


@register(
    "sales_with_plan",
    with_ctes(SQL_CTES, select="SELECT store_id, dept, week, CAST(sales AS DOUBLE) AS sales, is_plan FROM f_plan"),
)
def sales_with_plan(spark, sf_dir):
    return fc.with_plan(_history(spark, sf_dir)).withColumn("sales", F.col("sales").cast("double"))


@register(
    "sales_lags",
    with_ctes(
        SQL_CTES,
        select="SELECT store_id, dept, week, is_plan, lag_1, lag_2, lag_3, lag_4 FROM f_lags",
    ),
)
def sales_lags(spark, sf_dir):
    return _lags(spark, sf_dir).select("store_id", "dept", "week", "is_plan", "lag_1", "lag_2", "lag_3", "lag_4")


@register(
    "sales_rolling",
    with_ctes(SQL_CTES, select="SELECT store_id, dept, week, is_plan, rolling_mean_4 FROM f_lags"),
)
def sales_rolling(spark, sf_dir):
    return _lags(spark, sf_dir).select("store_id", "dept", "week", "is_plan", "rolling_mean_4")


_HOLIDAY_DAYS = " OR ".join(
    f"strftime(week + INTERVAL {d} DAY, '%m-%d') IN ({HOLIDAY_LIST})" for d in range(7)
)


@register(
    "calendar",
    with_ctes(
        SQL_CTES,
        select=f"""SELECT week, CAST(weekofyear(week) AS INTEGER) AS week_of_year, CAST(month(week) AS INTEGER) AS month,
       CAST(quarter(week) AS INTEGER) AS quarter, CAST(year(week) AS INTEGER) AS year,
       ({_HOLIDAY_DAYS}) AS is_holiday_week
FROM (SELECT DISTINCT week FROM f_plan)""",
    ),
)
def calendar(spark, sf_dir):
    weeks = fc.with_plan(_history(spark, sf_dir)).select("week").distinct()
    return fc.calendar_features(weeks)


_LONG = "\n  UNION ALL\n  ".join(
    f"SELECT week >= TIMESTAMP '{CURRENT_FROM}' AS cur, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM f_lags WHERE NOT is_plan"
    for f in PSI_FEATURES
)
_BUCKET = " + ".join(f"CAST(l.x > e.edges[{i}] AS INTEGER)" for i in range(1, 10))


@register(
    "psi",
    with_ctes(
        SQL_CTES,
        f"""long AS (
  {_LONG}
),
long2 AS (SELECT * FROM long WHERE x IS NOT NULL),
edges AS (
  SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
  FROM long2 WHERE NOT cur GROUP BY feature
),
b AS (SELECT l.feature, l.cur, {_BUCKET} AS bucket FROM long2 l JOIN edges e ON l.feature = e.feature),
sh AS (
  SELECT feature, cur, bucket, count(*) / sum(count(*)) OVER (PARTITION BY feature, cur) AS share
  FROM b GROUP BY feature, cur, bucket
),
both_ AS (
  SELECT coalesce(x.feature, y.feature) AS feature, greatest(coalesce(x.share, 0.0), 1e-6) AS e,
         greatest(coalesce(y.share, 0.0), 1e-6) AS a
  FROM (SELECT * FROM sh WHERE NOT cur) x FULL OUTER JOIN (SELECT * FROM sh WHERE cur) y
    ON x.feature = y.feature AND x.bucket = y.bucket
)""",
        select="SELECT feature, round(sum((a - e) * ln(a / e)), 9) AS psi FROM both_ GROUP BY feature",
    ),
)
def psi(spark, sf_dir):
    hist = _lags(spark, sf_dir).where(~F.col("is_plan"))
    out = fc.psi(hist, PSI_FEATURES, F.col("week") >= F.lit(CURRENT_FROM).cast("timestamp_ntz"))
    return rounded(out, {"psi": 9})


@register(
    "clip_forecast",
    with_ctes(
        SQL_CTES,
        select="SELECT store_id, dept, week, forecast FROM f_fc WHERE raw_forecast IS NOT NULL",
    ),
)
def clip_forecast(spark, sf_dir):
    f = fc.naive_forecast(_lags(spark, sf_dir).where(~F.col("is_plan")))
    return f.where(F.col("raw_forecast").isNotNull()).select("store_id", "dept", "week", "forecast")


@register(
    "reg_metrics",
    with_ctes(
        SQL_CTES,
        select="""SELECT count(*) AS n,
       round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) AS r2,
       round(avg(abs(y - p)), 6) AS mae
FROM (SELECT CAST(sales AS DOUBLE) AS y, forecast AS p FROM f_fc WHERE sales IS NOT NULL AND forecast IS NOT NULL)""",
    ),
)
def reg_metrics(spark, sf_dir):
    f = fc.naive_forecast(_lags(spark, sf_dir).where(~F.col("is_plan")))
    return rounded(fc.regression_metrics(f, "sales", "forecast"), {"r2": 9, "mae": 6})
