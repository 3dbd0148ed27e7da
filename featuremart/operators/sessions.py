"""Session features: session counts per window and mean session length."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.columns import in_window, seconds_between, ts_literal, window_start

from featuremart.operators.constants import DEFAULT_WINDOWS, LENGTH_WINDOW  # noqa: E402


def session_spans(rollup: DataFrame) -> DataFrame:
    """First and last product event per session, from the event rollup.

    Grouping the ``(session_id, product_id)`` rollup again by session gives
    the same min/max as grouping raw events, on far fewer rows. A NULL
    session id forms its own group here; callers join with plain equality,
    so it never attaches to a session.
    """
    return rollup.groupBy("session_id").agg(
        F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end")
    )


def session_lengths(sessions: DataFrame, spans: DataFrame) -> DataFrame:
    """Sessions with ``duration_seconds`` (0 when no product event)."""
    joined = sessions.join(spans, "session_id", "left")
    dur = F.coalesce(seconds_between("session_start", "session_end"), F.lit(0.0))
    return joined.withColumn("duration_seconds", dur)


def session_features(
    sessions: DataFrame,
    spans: DataFrame,
    run_date: dt.datetime,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    length_window: int = LENGTH_WINDOW,
) -> DataFrame:
    """Per customer: ``avg_session_length_<L>`` and ``sessions_<n>``.

    Only sessions inside the widest window can contribute, so the rest is
    filtered before the span join.
    """
    widest = max(list(windows) + [length_window])
    recent = sessions.where(
        F.col("customer_id").isNotNull()
        & (F.col("start_time") >= ts_literal(window_start(run_date, widest)))
        & (F.col("start_time") < ts_literal(run_date))
    )
    lengths = session_lengths(recent, spans)
    aggs = [
        F.avg(
            F.when(in_window("start_time", run_date, length_window), F.col("duration_seconds"))
        ).alias(f"avg_session_length_{length_window}")
    ]
    aggs += [F.count_if(in_window("start_time", run_date, n)).alias(f"sessions_{n}") for n in windows]
    return lengths.groupBy("customer_id").agg(*aggs)
