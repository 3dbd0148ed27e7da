"""Order features: recency over all history, count / sum / mean over a window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.columns import days_between, in_window, lenient_double, ts_literal

from featuremart.operators.constants import ORDER_WINDOW  # noqa: E402


def order_features(orders: DataFrame, run_date: dt.datetime, window: int = ORDER_WINDOW) -> DataFrame:
    """One conditional aggregate over one scan of cleaned orders.

    ``last_order_time`` covers all history before ``run_date``; the window
    features only orders inside ``[run_date - window, run_date)``. Malformed
    totals count as 0 and stay in the mean's denominator.
    """
    usd = lenient_double("total_usd", orders.schema["total_usd"].dataType)
    inw = in_window("order_time", run_date, window)
    per_customer = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max("order_time").alias("last_order_time"),
        F.count_if(inw).alias(f"orders_{window}"),
        F.sum(F.when(inw, usd)).alias(f"sum_total_usd_{window}"),
        F.avg(F.when(inw, usd)).alias(f"avg_total_usd_{window}"),
    )
    days = days_between("last_order_time", ts_literal(run_date))
    return per_customer.select(
        "customer_id",
        days.alias("days_since_last_purchase"),
        f"orders_{window}",
        f"sum_total_usd_{window}",
        f"avg_total_usd_{window}",
    )
