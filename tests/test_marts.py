"""Hand-computed expectations for the marketplace mart on a tiny fixture."""

import datetime as dt
from decimal import Decimal

import pytest

from featuremart.plans import marts

D = dt.datetime


@pytest.fixture(scope="module")
def data(spark):
    users = spark.createDataFrame(
        [(1, "EU"), (2, "EU"), (3, "ASIA"), (4, "ASIA"), (5, "AFRICA")], "user_id long, region string"
    )
    rows = []
    oid = 0
    # user 1: 1 order; user 2: 5 orders; user 3: 6 orders; user 4: 11 orders; user 5: none
    for user, n in ((1, 1), (2, 5), (3, 6), (4, 11)):
        for k in range(n):
            oid += 1
            rows.append((oid, user, D(1995, 1 + (k % 12), 10), Decimal("10.00") * user))
    orders = spark.createDataFrame(rows, "order_id long, user_id long, order_time timestamp_ntz, amount decimal(18,2)")
    payments = spark.createDataFrame([(1, Decimal("4.50")), (1, Decimal("5.50"))], "order_id long, paid decimal(18,2)")
    return users, orders, payments


def test_segments_boundaries(spark, data):
    users, orders, payments = data
    seg = {r["segment"]: r for r in marts.order_segments(marts.user_mart(users, orders, payments)).collect()}
    assert {k: seg[k]["users"] for k in seg} == {"1": 1, "2-5": 1, "6-10": 1, "11+": 1}
    assert seg["11+"]["avg_check"] == 40.0


def test_user_mart_rows_and_payments(spark, data):
    users, orders, payments = data
    mart = {r["user_id"]: r for r in marts.user_mart(users, orders, payments).collect()}
    assert len(mart) == 5
    assert mart[5]["n_orders"] == 0 and mart[5]["revenue"] == 0
    assert mart[1]["n_payments"] == 2 and float(mart[1]["paid"]) == 10.0
    assert float(mart[4]["revenue"]) == 440.0


def test_top_regions(spark, data):
    users, orders, payments = data
    top = [r["region"] for r in marts.top_regions(marts.user_mart(users, orders, payments), 2).collect()]
    assert top == ["ASIA", "EU"]  # ASIA 6*30 + 11*40 = 620, EU 10 + 5*20 = 110


def test_cohorts_retention(spark, data):
    _, orders, _ = data
    cells = {(r["cohort_month"], r["month_offset"]): r for r in marts.cohorts(orders, 1995).collect()}
    jan = dt.date(1995, 1, 1)
    # every user first orders in January; users 2, 3, 4 are active in February
    assert cells[(jan, 0)]["users"] == 4 and cells[(jan, 0)]["cohort_size"] == 4
    assert cells[(jan, 1)]["users"] == 3 and cells[(jan, 1)]["retention"] == pytest.approx(0.75)
    # only user 4 (11 orders, months 1..11) is active in November
    assert cells[(jan, 10)]["users"] == 1


def test_ltv_by_repeat(spark, data):
    _, orders, _ = data
    rows = {r["is_repeat"]: r for r in marts.ltv_by_repeat(orders).collect()}
    assert rows[False]["users"] == 1 and rows[False]["avg_ltv"] == 10.0
    assert rows[True]["users"] == 3
    assert rows[True]["avg_ltv"] == pytest.approx((100 + 180 + 440) / 3)
    assert rows[True]["orders_per_active_month"] == pytest.approx(1.0)
