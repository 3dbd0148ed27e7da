"""The batch feature build: one row per customer for one run date.

Shuffles, in order: dedupe keys (event, session, order ids), the
``(session_id, product_id)`` rollup, ``session_id`` for attribution and
spans, ``(customer_id, product_id)``, ``customer_id``. Every fact table is
read once; the three per-customer frames arrive hash-partitioned by
``customer_id`` and are joined to the distinct customer spine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.columns import ts_literal
from featuremart.operators.conversions import add_conversions, conversion_columns
from featuremart.operators.events import (
    event_feature_columns,
    event_window_features,
    session_product_rollup,
)
from featuremart.operators.orders import ORDER_WINDOW, order_features
from featuremart.operators.sessions import LENGTH_WINDOW, session_features, session_spans
from featuremart.sources.tables import CleanSources, Sources, clean_sources

from featuremart.operators.constants import DEFAULT_WINDOWS  # noqa: E402


def feature_columns(windows: Sequence[int] = DEFAULT_WINDOWS) -> list[str]:
    """The output contract, in order (21 columns for the default windows)."""
    return (
        ["customer_id"]
        + event_feature_columns(windows)
        + [f"avg_session_length_{LENGTH_WINDOW}"]
        + [f"sessions_{n}" for n in windows]
        + ["days_since_last_purchase", f"orders_{ORDER_WINDOW}"]
        + [f"sum_total_usd_{ORDER_WINDOW}", f"avg_total_usd_{ORDER_WINDOW}"]
        + conversion_columns(windows)
        + ["run_date"]
    )


def count_columns(windows: Sequence[int] = DEFAULT_WINDOWS) -> list[str]:
    return event_feature_columns(windows) + [f"sessions_{n}" for n in windows] + [f"orders_{ORDER_WINDOW}"]


def double_columns() -> list[str]:
    return [
        f"avg_session_length_{LENGTH_WINDOW}",
        f"sum_total_usd_{ORDER_WINDOW}",
        f"avg_total_usd_{ORDER_WINDOW}",
    ]


def customer_spine(customers: DataFrame) -> DataFrame:
    """All distinct customer ids (a NULL id stays as one row)."""
    return customers.select("customer_id").distinct()


def build_from_clean(
    clean: CleanSources, windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill_conversions: bool = False
) -> DataFrame:
    run_date = clean.run_date
    rollup = session_product_rollup(clean.events, run_date, windows)
    events_f = event_window_features(rollup, clean.sessions, windows)
    sessions_f = session_features(clean.sessions, session_spans(rollup), run_date, windows)
    orders_f = order_features(clean.orders, run_date)

    return assembled(clean.customers, events_f, sessions_f, orders_f, run_date, windows, zero_fill_conversions)


def assembled(
    customers: DataFrame,
    events_f: DataFrame,
    sessions_f: DataFrame,
    orders_f: DataFrame,
    run_date: dt.datetime,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    zero_fill_conversions: bool = False,
) -> DataFrame:
    """The spine with the three per-customer frames, conversions and fills."""
    wide = (
        customer_spine(customers)
        .join(events_f, "customer_id", "left")
        .join(sessions_f, "customer_id", "left")
        .join(orders_f, "customer_id", "left")
    )
    return contracted(wide.withColumn("run_date", ts_literal(run_date)), windows, zero_fill_conversions)


def contracted(wide: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill_conversions: bool = False) -> DataFrame:
    """Conversions, fills and the columns of the output contract."""
    # Ratios first: they read the counts before the zero fill.
    wide = add_conversions(wide, windows, zero_fill_conversions)
    fills = {c: F.coalesce(F.col(c), F.lit(0)).cast(T.LongType()) for c in count_columns(windows)}
    fills.update({c: F.coalesce(F.col(c), F.lit(0.0)) for c in double_columns()})
    fills["days_since_last_purchase"] = F.coalesce(F.col("days_since_last_purchase"), F.lit(-1)).cast(
        T.LongType()
    )
    return wide.withColumns(fills).select(*feature_columns(windows))


def build_batch_features(
    src: Sources, windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill_conversions: bool = False
) -> DataFrame:
    """Lazy feature frame for ``src.run_date``; nothing runs until an action."""
    return build_from_clean(clean_sources(src), windows, zero_fill_conversions)
