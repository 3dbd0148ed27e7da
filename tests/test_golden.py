"""The hand-worked micro-fixture, value by value."""

import datetime as dt

import pytest

from featuremart.plans.batch_features import build_batch_features, feature_columns
from tests.fixtures import EXPECTED, RUN, micro_sources


@pytest.fixture(scope="module")
def result(spark):
    df = build_batch_features(micro_sources(spark))
    return df, {r["customer_id"]: r.asDict() for r in df.collect()}


def test_schema_and_order(result):
    df, _ = result
    assert df.columns == feature_columns()
    assert len(df.columns) == 21
    types = dict(df.dtypes)
    assert types["page_view_7"] == "bigint"
    assert types["days_since_last_purchase"] == "bigint"
    assert types["avg_session_length_30"] == "double"
    assert types["run_date"] == "timestamp_ntz"


def test_one_row_per_distinct_customer_including_null(result):
    _, rows = result
    assert set(rows) == {1, 2, 3, None}


@pytest.mark.parametrize("column", sorted(EXPECTED))
def test_expected_values(result, column):
    _, rows = result
    for cid, want in EXPECTED[column].items():
        got = rows[cid][column]
        if want is None:
            assert got is None, (column, cid, got)
        else:
            assert got == pytest.approx(want, abs=1e-9), (column, cid, got)


def test_run_date_stamped(result):
    _, rows = result
    assert all(r["run_date"] == RUN for r in rows.values())
    assert RUN == dt.datetime(2025, 6, 10)


def test_zero_fill_option(spark):
    df = build_batch_features(micro_sources(spark), zero_fill_conversions=True)
    rows = {r["customer_id"]: r for r in df.collect()}
    assert rows[2]["conversion_page_to_cart_7"] == 0.0
    assert rows[1]["conversion_page_to_cart_7"] == 2.0
