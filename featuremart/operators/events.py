"""Event window features: counts per type, distinct products, per customer.

Plan shape (one pass over events):

1. ``session_product_rollup``: group cleaned events by
   ``(session_id, product_id)`` with every window count and the first/last
   event time as conditional aggregates. This pre-aggregates before any
   join; the partial (map-side) step collapses hot keys.
2. ``event_window_features``: keep rollup rows with an event in the widest
   window, attribute them to customers through their session (null-safe
   equality, sessions of all history before ``run_date``), group by
   ``(customer_id, product_id)`` and then by ``customer_id``. Distinct
   products are counted by the two-level grouping, so no ``Expand`` is
   needed for two windows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.columns import in_window

from featuremart.operators.constants import COUNTED_TYPES, DEFAULT_WINDOWS  # noqa: E402


def attribute_events(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events left-joined to their session's customer (NULL keys match NULL)."""
    owners = sessions.select(F.col("session_id").alias("_sid"), "customer_id")
    joined = events.join(owners, events["session_id"].eqNullSafe(owners["_sid"]), "left")
    return joined.drop("_sid")


def session_product_rollup(
    events: DataFrame, run_date: dt.datetime, windows: Sequence[int] = DEFAULT_WINDOWS
) -> DataFrame:
    """``(session_id, product_id)`` → window counts, ``first_ts``, ``last_ts``."""
    aggs = []
    for n in windows:
        inw = in_window("timestamp", run_date, n)
        for etype in COUNTED_TYPES:
            aggs.append(F.count_if(inw & (F.col("event_type") == etype)).alias(f"{etype}_{n}"))
        aggs.append(F.count_if(inw).alias(f"any_{n}"))
    aggs += [F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")]
    return events.groupBy("session_id", "product_id").agg(*aggs)


def event_window_features(
    rollup: DataFrame, sessions: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS
) -> DataFrame:
    """Per customer: ``<type>_<n>`` counts and ``unique_products_<n>``.

    Customers without any event in a window are absent (filled later).
    Events of unknown sessions or customers are dropped before the shuffle.
    """
    widest = max(windows)
    count_cols = [f"{t}_{n}" for n in windows for t in COUNTED_TYPES]
    any_cols = [f"any_{n}" for n in windows]
    recent = rollup.where(F.col(f"any_{widest}") > 0).select(
        "session_id", "product_id", *count_cols, *any_cols
    )
    owners = sessions.where(F.col("customer_id").isNotNull()).select(
        F.col("session_id").alias("_sid"), "customer_id"
    )
    attributed = recent.join(owners, recent["session_id"].eqNullSafe(owners["_sid"]), "inner")
    per_product = attributed.groupBy("customer_id", "product_id").agg(
        *[F.sum(c).alias(c) for c in count_cols + any_cols]
    )
    out = []
    for n in windows:
        out += [F.sum(f"{t}_{n}").alias(f"{t}_{n}") for t in COUNTED_TYPES]
        out.append(F.count_if(F.col(f"any_{n}") > 0).alias(f"unique_products_{n}"))
    return per_product.groupBy("customer_id").agg(*out)


def event_feature_columns(windows: Sequence[int] = DEFAULT_WINDOWS) -> list[str]:
    cols = []
    for n in windows:
        cols += [f"{t}_{n}" for t in COUNTED_TYPES] + [f"unique_products_{n}"]
    return cols
