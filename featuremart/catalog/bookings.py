"""Checks for the booking-cancellation analysis (prose-described)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.plans import bookings as bk
from featuremart.sources import hotel
from featuremart.sources.hotel import SQL_CTES


def _book(spark, sf_dir):
    return hotel.bookings(spark, sf_dir)


@register(
    "stay_features",
    with_ctes(
        SQL_CTES,
        select="""SELECT booking_id, arrival, arrival + stay_nights * INTERVAL 1 DAY AS departure, stay_nights,
       CAST(month(arrival) AS INTEGER) AS arrival_month, CAST(quarter(arrival) AS INTEGER) AS arrival_quarter,
       CAST(dayofweek(arrival) + 1 AS INTEGER) AS arrival_dow,
       CASE WHEN month(arrival) IN (12, 1, 2) THEN 'winter' WHEN month(arrival) IN (3, 4, 5) THEN 'spring'
            WHEN month(arrival) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       dayofweek(arrival) IN (0, 6) AS weekend_arrival
FROM h_book""",
    ),
)
def stay_features(spark, sf_dir):
    return bk.stay_features(_book(spark, sf_dir))


@register(
    "prior_bookings",
    with_ctes(
        SQL_CTES,
        select="""SELECT booking_id, customer_id, arrival, is_canceled,
       count(*) OVER w AS prior_bookings,
       CAST(coalesce(sum(CAST(is_canceled AS BIGINT)) OVER w, 0) AS BIGINT) AS prior_cancellations
FROM h_book
WINDOW w AS (PARTITION BY customer_id ORDER BY arrival, booking_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    ),
)
def prior_bookings(spark, sf_dir):
    return bk.prior_bookings(_book(spark, sf_dir))


@register(
    "tfidf_sql",
    """WITH tokens AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS term FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens WHERE term <> '' GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM documents)
SELECT tf.doc_id, tf.term, tf.tf, df.df, round(ln((m.m + 1) / (df.df + 1)), 9) AS idf,
       round(tf.tf * ln((m.m + 1) / (df.df + 1)), 9) AS tfidf
FROM tf JOIN df ON tf.term = df.term, m""",
)
def tfidf_sql(spark, sf_dir):
    return rounded(bk.review_tfidf(hotel.reviews(spark, sf_dir)), {"idf": 9, "tfidf": 9})


@register(
    "time_folds",
    with_ctes(
        SQL_CTES,
        """per AS (SELECT *, date_trunc('month', arrival) AS period FROM h_book),
idx AS (SELECT period, dense_rank() OVER (ORDER BY period) - 1 AS i FROM (SELECT DISTINCT period FROM per)),
pt AS (SELECT count(*) AS p, count(*) // 6 AS h FROM idx),
assign AS (
  SELECT f.k AS fold, per.period,
         CASE WHEN idx.i < pt.p - (5 - f.k + 1) * pt.h THEN 'train'
              WHEN idx.i < pt.p - (5 - f.k) * pt.h THEN 'test' END AS split
  FROM per JOIN idx ON per.period = idx.period, pt, range(1, 6) f(k)
)""",
        select="""SELECT CAST(fold AS INTEGER) AS fold, split, count(*) AS rows, min(period) AS first_period, max(period) AS last_period
FROM assign WHERE split IS NOT NULL GROUP BY fold, split""",
    ),
)
def time_folds(spark, sf_dir):
    return bk.time_folds(_book(spark, sf_dir), folds=5).withColumn("fold", F.col("fold").cast("int"))


@register(
    "ir_threshold",
    with_ctes(
        SQL_CTES,
        """g AS (
  SELECT score_bucket AS k, count(*) AS n,
         sum(CASE WHEN is_canceled THEN price * 0.50 ELSE -price * 0.10 END) AS ir
  FROM h_book GROUP BY score_bucket
),
grid AS (SELECT CAST(range AS INTEGER) AS k FROM range(0, 21)),
per_k AS (SELECT grid.k, coalesce(g.n, 0) AS n, coalesce(g.ir, 0) AS ir FROM grid LEFT JOIN g ON grid.k = g.k),
swept AS (
  SELECT k / 20 AS threshold,
         sum(n) OVER (ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS flagged,
         sum(ir) OVER (ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ir
  FROM per_k
)""",
        select="""SELECT threshold, CAST(flagged AS BIGINT) AS flagged, CAST(ir AS DOUBLE) AS ir,
       row_number() OVER (ORDER BY ir DESC, threshold) = 1 AS is_best
FROM swept""",
    ),
)
def ir_threshold(spark, sf_dir):
    out = bk.threshold_sweep(_book(spark, sf_dir), grid=hotel.GRID)
    return out.withColumns({"ir": F.col("ir").cast("double"), "flagged": F.col("flagged").cast("long")})


@register(
    "policy_outcome",
    with_ctes(
        SQL_CTES,
        select="""SELECT 'before' AS scenario, count(*) AS bookings, count(*) FILTER (WHERE is_canceled) / count(*) AS cancel_share,
       CAST(coalesce(sum(price) FILTER (WHERE NOT is_canceled), 0) AS DOUBLE) AS revenue,
       CAST(coalesce(sum(stay_nights) FILTER (WHERE NOT is_canceled), 0) AS BIGINT) AS occupied_nights
FROM h_book
UNION ALL
SELECT 'after', count(*), count(*) FILTER (WHERE is_canceled) / count(*),
       CAST(coalesce(sum(price) FILTER (WHERE NOT is_canceled), 0) AS DOUBLE),
       CAST(coalesce(sum(stay_nights) FILTER (WHERE NOT is_canceled), 0) AS BIGINT)
FROM h_book WHERE score_bucket < 10""",
    ),
)
def policy_outcome(spark, sf_dir):
    out = bk.policy_outcome(_book(spark, sf_dir), grid=hotel.GRID, k=10)
    return out.withColumns({"revenue": F.col("revenue").cast("double"), "occupied_nights": F.col("occupied_nights").cast("long")})
