"""Distinct products of sliding windows from a last-seen state.

For each customer and product the state holds the time of the last event. A
window that ends where the state ends holds a product exactly if its last event
is not older than the window, so every window's distinct count is a
conditional count over the state: one state serves all window lengths, and the
next run date only reads the events since.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.columns import ts_literal, window_start
from featuremart.operators.constants import DEFAULT_WINDOWS

STATE = ("customer_id", "product_id", "last_ts")


def last_seen(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """State of cleaned events, attributed through their sessions (NULL matches
    NULL); events of unknown sessions or customers are left out."""
    per_session = events.groupBy("session_id", "product_id").agg(F.max("timestamp").alias("last_ts"))
    owners = sessions.where(F.col("customer_id").isNotNull()).select(F.col("session_id").alias("_sid"), "customer_id")
    attributed = per_session.join(owners, per_session["session_id"].eqNullSafe(owners["_sid"]))
    return attributed.groupBy("customer_id", "product_id").agg(F.max("last_ts").alias("last_ts"))


def advanced(state: DataFrame, newer: DataFrame) -> DataFrame:
    """The state after further events (themselves as a state)."""
    both = state.select(*STATE).unionByName(newer.select(*STATE))
    return both.groupBy("customer_id", "product_id").agg(F.max("last_ts").alias("last_ts"))


def window_products(state: DataFrame, run_date: dt.datetime, windows: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    """``customer_id, unique_products_<n>`` of customers with a product in the widest
    window. ``state`` holds all events before ``run_date`` and none from it on."""
    since = lambda n: F.col("last_ts") >= ts_literal(window_start(run_date, n))
    recent = state.where(since(max(windows)))
    return recent.groupBy("customer_id").agg(*[F.count_if(since(n)).alias(f"unique_products_{n}") for n in windows])
