"""Source parsing: zoned text keeps its wall time (zone dropped), numeric
money is only widened, missing columns are rejected."""

import datetime as dt

import pytest

from featuremart.plans.batch_features import build_batch_features
from featuremart.sources.tables import Sources, clean_sources


def _src(spark, event_ts: str, total):
    customers = spark.createDataFrame([(1, "2025-01-01")], "customer_id long, signup_date string")
    sessions = spark.createDataFrame([(10, 1, "2025-06-05T09:00:00+03:00")], "session_id long, customer_id long, start_time string")
    events = spark.createDataFrame(
        [(100, 10, event_ts, "page_view", "A")], "event_id long, session_id long, timestamp string, event_type string, product_id string"
    )
    orders = spark.createDataFrame([(1000, 1, "2025-06-09 23:00:00", total)], f"order_id long, customer_id long, order_time string, total_usd {'double' if isinstance(total, float) else 'string'}")
    return Sources(customers, sessions, events, orders, dt.datetime(2025, 6, 10))


def test_zoned_text_keeps_wall_time(spark):
    clean = clean_sources(_src(spark, "2025-06-09T23:30:00+05:00", "1.5"))
    ev = clean.events.collect()
    assert ev[0]["timestamp"] == dt.datetime(2025, 6, 9, 23, 30)
    assert clean.sessions.collect()[0]["start_time"] == dt.datetime(2025, 6, 5, 9, 0)


def test_numeric_total_is_widened(spark):
    row = build_batch_features(_src(spark, "2025-06-09T10:00:00Z", 12.25)).collect()[0]
    assert row["sum_total_usd_30"] == 12.25
    assert row["days_since_last_purchase"] == 0


def test_missing_column_rejected(spark):
    src = _src(spark, "2025-06-09T10:00:00", "1")
    bad = Sources(src.customers, src.sessions, src.events.drop("product_id"), src.orders, src.run_date)
    with pytest.raises(ValueError):
        clean_sources(bad)
