"""Checks for the age-group feature set and its evaluation (prose-described)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.plans import usage as us
from featuremart.sources import usage as src
from featuremart.sources.usage import CATEGORIES, SQL_CTES

STAT_DIGITS = {"avg_value": 9, "std_value": 9}


def wide_users(spark, sf_dir):
    return us.user_wide(
        src.users(spark, sf_dir), src.visits(spark, sf_dir), src.orders(spark, sf_dir), src.order_lines(spark, sf_dir),
        CATEGORIES, src.device_sessions(spark, sf_dir), src.ad_views(spark, sf_dir), src.cloud_usage(spark, sf_dir),
    )


_EXTRA = ("device_sessions", "device_seconds", "n_devices", "ad_views", "ad_size", "n_ad_sites",
          "cloud_operations", "cloud_bytes", "n_cloud_kinds")
WIDE_CTE = f"""u_wide AS (
  SELECT u.user_id, u.region, u.acctbal, u.segment, coalesce(s.visits, 0) AS visits,
       s.avg_value, s.std_value, s.min_value, s.max_value,
       coalesce(s.n_categories, 0) AS n_categories, s.first_visit, s.last_visit,
       sh.share_view, sh.share_click, sh.share_purchase, sh.share_signup, sh.share_error,
       coalesce(o.n_orders, 0) AS n_orders, CAST(o.order_amount AS DOUBLE) AS order_amount,
       coalesce(o.n_lines, 0) AS n_lines, CAST(o.quantity AS DOUBLE) AS quantity,
       {", ".join(f"coalesce({c}, 0) AS {c}" for c in _EXTRA)}
  FROM u_users u LEFT JOIN u_stats s ON u.user_id = s.user_id LEFT JOIN u_shares sh ON u.user_id = sh.user_id
  LEFT JOIN u_orders o ON u.user_id = o.user_id LEFT JOIN u_device d ON u.user_id = d.user_id
  LEFT JOIN u_ads a ON u.user_id = a.user_id LEFT JOIN u_cloud cl ON u.user_id = cl.user_id
)"""


@register(
    "category_shares",
    with_ctes(SQL_CTES, select="SELECT * FROM u_shares"),
)
def category_shares(spark, sf_dir):
    return us.category_shares(src.visits(spark, sf_dir), CATEGORIES)


@register(
    "usage_stats",
    with_ctes(
        SQL_CTES,
        select="""SELECT user_id, visits, round(avg_value, 9) AS avg_value, round(std_value, 9) AS std_value,
       min_value, max_value, n_categories, first_visit, last_visit FROM u_stats""",
    ),
)
def usage_stats(spark, sf_dir):
    return rounded(us.usage_stats(src.visits(spark, sf_dir)), STAT_DIGITS)


@register(
    "user_wide",
    with_ctes(
        SQL_CTES,
        WIDE_CTE,
        select="SELECT * REPLACE (round(avg_value, 9) AS avg_value, round(std_value, 9) AS std_value) FROM u_wide",
    ),
)
def user_wide(spark, sf_dir):
    w = wide_users(spark, sf_dir).withColumns(
        {"order_amount": F.col("order_amount").cast("double"), "quantity": F.col("quantity").cast("double")}
    )
    return rounded(w, STAT_DIGITS)


@register(
    "macro_f1",
    """WITH d AS (
  SELECT l.quality AS y, CAST(d.n_chars >= 1000 AS INTEGER) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
classes AS (SELECT y AS c FROM d UNION SELECT p FROM d),
per AS (
  SELECT c, count(*) FILTER (WHERE y = c AND p = c) AS tp, count(*) FILTER (WHERE y <> c AND p = c) AS fp,
         count(*) FILTER (WHERE y = c AND p <> c) AS fn, count(*) FILTER (WHERE y = c) AS support
  FROM classes, d GROUP BY c
),
f AS (
  SELECT c, support,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc
  FROM per
)
SELECT round(avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END), 9) AS macro_f1,
       count(*) AS classes, CAST(sum(support) AS BIGINT) AS n FROM f""",
)
def macro_f1(spark, sf_dir):
    return rounded(us.macro_f1(src.labelled_docs(spark, sf_dir), "label", "prediction"), {"macro_f1": 9})
