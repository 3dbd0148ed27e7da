"""Hotel-booking cancellation analysis: stay features, leakage-free history
features, review TF-IDF, time-ordered folds, threshold choice by incremental
revenue and the before/after policy outcome.

Input ``bookings(booking_id, customer_id, arrival, stay_nights, price,
is_canceled, score_bucket)``; ``reviews(doc_id, text)``. ``score_bucket``
is the cancellation score on an integer grid 0..``grid`` (score ≥ k/grid
⇔ bucket ≥ k), so thresholds compare integers, never rounded doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.parallelism import spread_for_cpu
from featuremart.operators.sequence import running_sums_within
from featuremart.session import stored

# Meteorological seasons by month.
SEASONS = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
           6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn"}
TOKEN_SPLIT = r"[^\p{L}]+"


def stay_features(bookings: DataFrame) -> DataFrame:
    m = F.month("arrival")
    season = None
    for month, name in SEASONS.items():
        season = F.when(m == month, F.lit(name)) if season is None else season.when(m == month, F.lit(name))
    dow = F.dayofweek("arrival")  # 1 = Sunday … 7 = Saturday
    return bookings.select(
        "booking_id",
        "arrival",
        F.timestamp_add("DAY", F.col("stay_nights"), F.col("arrival")).alias("departure"),
        "stay_nights",
        m.alias("arrival_month"),
        F.quarter("arrival").alias("arrival_quarter"),
        dow.alias("arrival_dow"),
        season.alias("season"),
        dow.isin(1, 7).alias("weekend_arrival"),
    )


def prior_bookings(bookings: DataFrame) -> DataFrame:
    """Earlier bookings and cancellations of the same customer (the current
    booking excluded, so no label leaks). Running totals by month: a customer
    with a third of all bookings is still split across tasks."""
    return running_sums_within(
        bookings.select("booking_id", "customer_id", "arrival", "is_canceled"),
        ["customer_id"],
        ["arrival", "booking_id"],
        {"prior_bookings": F.lit(1), "prior_cancellations": F.col("is_canceled").cast("long")},
        inclusive=False,
    )


def _term_counts(reviews: DataFrame) -> DataFrame:
    """doc_id, term, tf of each text on its own. The sorted words of a text are
    counted by where a run of equal words begins, so nothing is shuffled."""
    words = reviews.where(F.col("text").isNotNull()).select("doc_id", F.sort_array(F.split(F.lower(F.col("text")), TOKEN_SPLIT)).alias("w"))
    begins = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: ~F.get("w", i).eqNullSafe(F.get("w", i - 1)))
    runs = words.withColumn("at", begins)
    counts = F.transform("at", lambda p, k: F.struct(F.get("w", p).alias("term"), (F.coalesce(F.get("at", k + 1), F.size("w")) - p).cast("long").alias("tf")))
    return runs.select("doc_id", F.inline(counts)).where(F.col("term") != "")


def review_tfidf(reviews: DataFrame, spread: int | None = None) -> DataFrame:
    """TF-IDF over whole review texts, idf = ln((m + 1) / (df + 1)) with m
    the number of reviews (the MLlib definition).

    Tokens are lower-cased letter runs. Each text is tokenised once, and its
    terms are counted within its row; only texts whose ``doc_id`` comes more than
    once are summed by (doc, term) with a shuffle. Term frequencies are stored,
    and document frequencies are counted from the stored table (with a map-side
    step, so a term present in every document is no hot spot) and stored too.
    Both sides of the join are then bare exchanges, so AQE can split a term that
    many documents hold.
    ``spread`` repartitions texts that arrive in few splits.
    """
    texts = spread_for_cpu(reviews.select("doc_id", "text"), spread, key="doc_id")
    per_id = reviews.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(per_id.where(F.col("n") > 1).select(F.col("doc_id").alias("_id")), "repeated-docs")
    if repeated.isEmpty():
        counted = _term_counts(texts)
    else:
        same = texts["doc_id"].eqNullSafe(repeated["_id"])
        once = _term_counts(texts.join(repeated, same, "left_anti"))
        again = _term_counts(texts.join(repeated, same, "left_semi")).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
        counted = once.unionByName(again)
    tf = stored(counted, "tf")
    df = stored(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")
    m = reviews.select(F.count(F.lit(1))).scalar()
    idf = F.log((m + 1) / (F.col("df") + 1))
    return tf.join(df, "term").select("doc_id", "term", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def with_period_index(bookings: DataFrame, period: str = "month", time_col: str = "arrival") -> DataFrame:
    """Rows with ``_period``, its dense index ``_idx`` and the number of periods ``_p``.

    The distinct-period table is bounded by the calendar, so its index is
    computed on one small partition; the planner broadcasts it when small.
    """
    per = bookings.withColumn("_period", F.date_trunc(period, time_col))
    periods = per.select("_period").distinct()
    idx = periods.withColumns(
        {
            "_idx": F.dense_rank().over(Window.orderBy("_period")) - 1,
            "_p": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )
    return per.join(idx, "_period")


def split_of_fold(k: int | Column, folds: int) -> Column:
    """``train``, ``test`` or NULL for a row of :func:`with_period_index` in fold k.

    With P distinct periods and h = P // (folds + 1), fold k trains on
    periods before P − (folds − k + 1)·h and tests on the next h periods.
    """
    k = F.lit(k) if isinstance(k, int) else k
    h = F.floor(F.col("_p") / (folds + 1))
    return F.when(F.col("_idx") < F.col("_p") - (folds - k + 1) * h, F.lit("train")).when(
        F.col("_idx") < F.col("_p") - (folds - k) * h, F.lit("test")
    )


def fold_assignments(bookings: DataFrame, folds: int = 5, period: str = "month", time_col: str = "arrival") -> DataFrame:
    """Every row once per fold it takes part in, with ``fold`` and ``split``."""
    rows = with_period_index(bookings, period, time_col)
    assign = F.transform(
        F.sequence(F.lit(1), F.lit(folds)), lambda k: F.struct(k.alias("fold"), split_of_fold(k, folds).alias("split"))
    )
    exploded = rows.withColumn("_a", F.explode(assign)).where(F.col("_a.split").isNotNull())
    return exploded.withColumns({"fold": F.col("_a.fold"), "split": F.col("_a.split")}).drop(
        "_a", "_idx", "_p"
    )


def time_folds(bookings: DataFrame, folds: int = 5, period: str = "month") -> DataFrame:
    """Per fold and split: rows and the first / last period covered.

    Rows are counted per period first, so only calendar-sized rows are
    repeated per fold."""
    per = with_period_index(bookings.select("arrival"), period).groupBy("_period", "_idx", "_p").agg(F.count(F.lit(1)).alias("_rows"))
    assign = F.transform(
        F.sequence(F.lit(1), F.lit(folds)), lambda k: F.struct(k.alias("fold"), split_of_fold(k, folds).alias("split"))
    )
    assigned = per.withColumn("_a", F.explode(assign)).where(F.col("_a.split").isNotNull()).select("_period", "_rows", "_a.*")
    return assigned.groupBy("fold", "split").agg(
        F.sum("_rows").alias("rows"),
        F.min("_period").alias("first_period"),
        F.max("_period").alias("last_period"),
    )


def threshold_sweep(
    bookings: DataFrame, grid: int = 20, gain_rate: str = "0.5", loss_rate: str = "0.1"
) -> DataFrame:
    """Incremental revenue of flagging bookings with score ≥ k/grid.

    IR(k) = Σ over flagged bookings of ``gain_rate·price`` when it would
    cancel, else ``−loss_rate·price``. Rows are pre-aggregated to the
    ``grid + 1`` score buckets; a running sum from the top gives every IR.
    ``is_best`` marks the highest IR; ties go to the lower threshold.
    """
    gain = F.when(F.col("is_canceled"), F.col("price") * F.lit(gain_rate).cast("decimal(3,2)")).otherwise(
        -F.col("price") * F.lit(loss_rate).cast("decimal(3,2)")
    )
    per_bucket = bookings.groupBy(F.col("score_bucket").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(gain).alias("ir")
    )
    grid_rows = bookings.sparkSession.range(0, grid + 1).select(
        F.col("id").cast("int").alias("k"), F.lit(0).cast("long").alias("n"), F.lit(None).alias("ir")
    )
    allk = per_bucket.unionByName(grid_rows.withColumn("ir", F.col("ir").cast(per_bucket.schema["ir"].dataType)))
    per_k = allk.groupBy("k").agg(F.sum("n").alias("n"), F.coalesce(F.sum("ir"), F.lit(0)).alias("ir"))
    top = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)  # ≤ grid + 1 rows
    swept = per_k.where(F.col("k").between(0, grid)).select(
        (F.col("k") / grid).alias("threshold"),
        F.sum("n").over(top).alias("flagged"),
        F.sum("ir").over(top).alias("ir"),
    )
    best = F.row_number().over(Window.orderBy(F.desc("ir"), F.asc("threshold"))) == 1
    return swept.withColumn("is_best", best)


def policy_outcome(bookings: DataFrame, grid: int = 20, k: int = 10) -> DataFrame:
    """Cancellation share, revenue and occupied nights before the policy and
    after declining bookings with score ≥ k/grid."""
    def summary(df: DataFrame, name: str) -> DataFrame:
        kept = ~F.col("is_canceled")
        return df.agg(
            F.lit(name).alias("scenario"),
            F.count(F.lit(1)).alias("bookings"),
            # no share where every booking was declined
            (F.count_if(F.col("is_canceled")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("cancel_share"),
            F.coalesce(F.sum(F.when(kept, F.col("price"))), F.lit(0)).alias("revenue"),
            F.coalesce(F.sum(F.when(kept, F.col("stay_nights"))), F.lit(0)).alias("occupied_nights"),
        )

    return summary(bookings, "before").unionByName(summary(bookings.where(F.col("score_bucket") < k), "after"))
