"""Properties of the feature build that must hold for any input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featuremart.plans.batch_features import build_batch_features
from featuremart.sources.standins import standin_sources
from featuremart.sources.tables import Sources
from tests.conftest import SF_SMALL
from tests.fixtures import CUSTOMERS, EVENTS, ORDERS, SESSIONS, micro_sources


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_window_counts_nest(spark):
    df = build_batch_features(standin_sources(spark, SF_SMALL))
    bad = df.where(
        (F.col("page_view_7") > F.col("page_view_30"))
        | (F.col("add_to_cart_7") > F.col("add_to_cart_30"))
        | (F.col("purchase_7") > F.col("purchase_30"))
        | (F.col("unique_products_7") > F.col("unique_products_30"))
        | (F.col("sessions_7") > F.col("sessions_30"))
    )
    assert bad.count() == 0


def test_rows_equal_distinct_customers(spark):
    src = standin_sources(spark, SF_SMALL)
    assert build_batch_features(src).count() == src.customers.select("customer_id").distinct().count()


def test_duplicating_inputs_changes_nothing(spark):
    base = _rows(build_batch_features(micro_sources(spark)))
    doubled = micro_sources(spark, EVENTS * 2, SESSIONS * 2, ORDERS * 2, CUSTOMERS * 2)
    assert _rows(build_batch_features(doubled)) == base


def test_input_order_changes_nothing(spark):
    base = _rows(build_batch_features(micro_sources(spark)))
    rev = micro_sources(spark, EVENTS[::-1], SESSIONS[::-1], ORDERS[::-1], CUSTOMERS[::-1])
    assert _rows(build_batch_features(rev)) == base


def test_rows_at_or_after_run_date_change_nothing(spark):
    base = _rows(build_batch_features(micro_sources(spark)))
    late = dt.datetime(2025, 6, 10, 12)
    events = EVENTS + [(500, 10, late, "page_view", "Z"), (501, 13, dt.datetime(2025, 6, 10), "add_to_cart", "Y")]
    sessions = SESSIONS + [(16, 1, late)]
    orders = ORDERS + [(2000, 1, late, "55"), (2001, 2, dt.datetime(2025, 6, 10), "1")]
    assert _rows(build_batch_features(micro_sources(spark, events, sessions, orders))) == base


def test_unequal_copies_dedupe_before_filter(spark):
    """The surviving copy is the earliest; a product-less earliest copy drops the event."""
    D = dt.datetime
    events = [
        (1, 10, D(2025, 6, 5, 9), "page_view", None),  # earliest copy, no product: event lost
        (1, 10, D(2025, 6, 5, 11), "page_view", "A"),
        (2, 10, D(2025, 6, 5, 12), "add_to_cart", "B"),
        (2, 10, D(2025, 6, 6, 12), "purchase", "B"),  # later copy loses
    ]
    src = micro_sources(spark, events=events, sessions=[(10, 1, D(2025, 6, 5, 8))], orders=[], customers=[(1, None)])
    row = build_batch_features(src).collect()[0]
    assert row["page_view_7"] == 0
    assert row["add_to_cart_7"] == 1
    assert row["purchase_7"] == 0
    assert row["unique_products_7"] == 1


def test_malformed_totals(spark):
    D = dt.datetime
    orders = [
        (1, 1, D(2025, 6, 1), "1.5d"),
        (2, 1, D(2025, 6, 2), "NaN"),
        (3, 1, D(2025, 6, 3), " 4.5 "),
        (4, 1, D(2025, 6, 4), None),
    ]
    src = micro_sources(spark, events=[], sessions=[], orders=orders, customers=[(1, None)])
    row = build_batch_features(src).collect()[0]
    assert row["orders_30"] == 4
    assert row["sum_total_usd_30"] == pytest.approx(4.5)
    assert row["avg_total_usd_30"] == pytest.approx(4.5 / 4)


def test_empty_customers_gives_empty_frame_with_schema(spark):
    src = micro_sources(spark, customers=[])
    df = build_batch_features(src)
    assert df.count() == 0
    assert len(df.columns) == 21


def test_zoned_run_date_rejected(spark):
    from featuremart.sources.tables import parse_run_date

    with pytest.raises(ValueError):
        parse_run_date("2025-06-10T00:00:00+03:00")
    assert parse_run_date("2025-06-10") == dt.datetime(2025, 6, 10)


def test_sources_type(spark):
    assert isinstance(micro_sources(spark), Sources)
