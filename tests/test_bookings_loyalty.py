"""Hand-computed expectations: threshold sweep, policy outcome, order gaps."""

import datetime as dt
from decimal import Decimal

import pytest

from featuremart.plans import bookings as bk
from featuremart.plans import loyalty as ly

D = dt.datetime


@pytest.fixture(scope="module")
def book(spark):
    rows = [
        # id, customer, arrival, nights, price, canceled, bucket (score = bucket / 4)
        (1, 1, D(2020, 1, 1), 2, Decimal("100.00"), True, 4),
        (2, 1, D(2020, 2, 1), 3, Decimal("200.00"), False, 3),
        (3, 2, D(2020, 3, 1), 1, Decimal("50.00"), True, 2),
        (4, 2, D(2020, 4, 1), 4, Decimal("80.00"), False, 0),
    ]
    return spark.createDataFrame(
        rows,
        "booking_id long, customer_id long, arrival timestamp_ntz, stay_nights int, price decimal(18,2), "
        "is_canceled boolean, score_bucket int",
    )


def test_threshold_sweep(spark, book):
    out = {r["threshold"]: r for r in bk.threshold_sweep(book, grid=4).collect()}
    # IR(k) = Σ over bucket ≥ k of (0.5·price if canceled else −0.1·price)
    assert float(out[1.0]["ir"]) == 50.0  # booking 1
    assert float(out[0.75]["ir"]) == 50.0 - 20.0  # + booking 2
    assert float(out[0.5]["ir"]) == 30.0 + 25.0  # + booking 3
    assert float(out[0.0]["ir"]) == 55.0 - 8.0  # + booking 4
    assert float(out[0.25]["ir"]) == 55.0  # bucket 1 is empty: ties with 0.5
    # ties on IR go to the lower threshold
    assert out[0.25]["is_best"] and sum(r["is_best"] for r in out.values()) == 1
    assert out[0.0]["flagged"] == 4 and out[1.0]["flagged"] == 1


def test_policy_outcome(spark, book):
    rows = {r["scenario"]: r for r in bk.policy_outcome(book, grid=4, k=2).collect()}
    assert rows["before"]["bookings"] == 4 and rows["before"]["cancel_share"] == 0.5
    assert float(rows["before"]["revenue"]) == 280.0 and rows["before"]["occupied_nights"] == 7
    assert rows["after"]["bookings"] == 1 and rows["after"]["cancel_share"] == 0.0
    assert float(rows["after"]["revenue"]) == 80.0 and rows["after"]["occupied_nights"] == 4


def test_prior_bookings(spark, book):
    rows = {r["booking_id"]: r for r in bk.prior_bookings(book).collect()}
    assert [rows[i]["prior_bookings"] for i in (1, 2, 3, 4)] == [0, 1, 0, 1]
    assert [rows[i]["prior_cancellations"] for i in (1, 2, 3, 4)] == [0, 1, 0, 1]


def test_order_gaps_and_profile(spark):
    orders = spark.createDataFrame(
        [
            (1, 7, D(2020, 1, 1), "RUB", Decimal("10.00"), "mobile", "concert", "EU", "x"),
            (2, 7, D(2020, 1, 11), "RUB", Decimal("20.00"), "desktop", "theatre", "EU", "x"),
            (3, 7, D(2020, 1, 31), "RUB", Decimal("30.00"), "mobile", "concert", "EU", "x"),
            (4, 8, D(2020, 2, 1), "RUB", Decimal("5.00"), "mobile", "standup", "ASIA", "y"),
        ],
        "order_id long, user_id long, order_time timestamp_ntz, currency string, amount decimal(18,2), "
        "device string, genre string, region string, service string",
    ).withColumn("revenue_rub", __import__("pyspark.sql.functions", fromlist=["col"]).col("amount"))
    gaps = {r["order_id"]: r["gap_days"] for r in ly.order_gaps(orders).collect()}
    assert gaps == {1: None, 2: 10, 3: 20, 4: None}
    prof = {r["user_id"]: r for r in ly.user_profile(ly.order_gaps(orders)).collect()}
    assert prof[7]["n_orders"] == 3 and prof[7]["avg_gap_days"] == 15.0
    assert prof[7]["first_genre"] == "concert" and prof[7]["n_genres"] == 2 and prof[7]["n_devices"] == 2
    assert prof[7]["avg_revenue_rub"] == 20.0 and prof[8]["is_two"] is False
    summary = ly.loyalty_summary(prof_df := ly.user_profile(ly.order_gaps(orders))).collect()[0]
    assert summary["users"] == 2 and summary["one_time_share"] == 0.5
    assert prof_df.count() == 2
