"""Hand-computed expectations for the weekly forecast features."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featuremart.plans import forecast as fc

W = [dt.datetime(2020, 1, 6) + dt.timedelta(days=7 * i) for i in range(6)]  # Mondays


@pytest.fixture(scope="module")
def history(spark):
    # one series with a missing week (W[2]); sales 10, 20, -, 40, 50
    rows = [(1, "A", W[i], Decimal(v)) for i, v in ((0, 10), (1, 20), (3, 40), (4, 50))]
    return spark.createDataFrame(rows, "store_id long, dept string, week timestamp_ntz, sales decimal(18,2)")


def test_plan_rows_follow_last_week(spark, history):
    frame = fc.with_plan(history, horizon=2)
    plan = sorted(r["week"] for r in frame.where("is_plan").collect())
    assert plan == [W[5], W[5] + dt.timedelta(days=7)]
    assert frame.where("is_plan AND sales IS NOT NULL").count() == 0


def test_lags_are_gap_safe(spark, history):
    rows = {r["week"]: r for r in fc.lag_features(fc.with_plan(history, horizon=1)).collect()}
    assert rows[W[1]]["lag_1"] == 10.0
    assert rows[W[3]]["lag_1"] is None  # W[2] is missing: no silent shift to W[1]
    assert rows[W[3]]["lag_2"] == 20.0
    assert rows[W[5]]["lag_1"] == 50.0 and rows[W[5]]["lag_2"] == 40.0  # first plan week
    # previous 4 weeks of W[4]: W[0..3] present 10, 20, 40 → 70/3
    assert rows[W[4]]["rolling_mean_4"] == pytest.approx(70 / 3)
    assert rows[W[0]]["rolling_mean_4"] is None


def test_calendar_holiday_week(spark):
    weeks = spark.createDataFrame([(dt.datetime(2019, 12, 30),), (dt.datetime(2020, 1, 13),)], "week timestamp_ntz")
    rows = {r["week"]: r for r in fc.calendar_features(weeks).collect()}
    assert rows[dt.datetime(2019, 12, 30)]["is_holiday_week"]  # contains 1 January
    assert not rows[dt.datetime(2020, 1, 13)]["is_holiday_week"]
    assert rows[dt.datetime(2020, 1, 13)]["week_of_year"] == 3


def test_metrics_and_clip(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    m = fc.regression_metrics(df, "y", "p").collect()[0]
    assert m["r2"] == pytest.approx(1 - 2 / 2) and m["mae"] == pytest.approx(2 / 3)
    clip = fc.naive_forecast(spark.createDataFrame([(1.0, 5.0)], "lag_1 double, lag_2 double")).collect()[0]
    assert clip["raw_forecast"] == -3.0 and clip["forecast"] == 0.0


def test_psi_by_hand(spark):
    base = [(False, float(v)) for v in range(1, 11)]  # deciles split 1..10 one value per bucket
    cur = [(True, 10.0)] * 10  # all current values in the top bucket
    df = spark.createDataFrame(base + cur, "cur boolean, x double")
    got = fc.psi(df, ["x"], F.col("cur"), cut_lineage=False).collect()[0]["psi"]
    e, a, floor = 0.1, 1.0, 1e-6
    want = (a - e) * math.log(a / e) + 9 * (floor - e) * math.log(floor / e)
    assert got == pytest.approx(want)


class _LastWeekPlusTen:
    """Stands for a model: next week sells 10 more than the last."""

    def transform(self, df):
        return df.withColumn("prediction", F.when(F.col("has_lag_1") == 1, F.col("lag_1") + 10).otherwise(F.lit(-5.0)))


def test_plan_weeks_build_on_forecasts(spark):
    from featuremart.models.sales_model import predict_horizon, series_state

    history = spark.createDataFrame(
        [(1, "a", "2024-01-01", 5.0), (1, "a", "2024-01-08", 7.0), (2, "b", "2024-01-01", 3.0)], "store_id long, dept string, w string, sales double"
    ).withColumn("week", F.col("w").cast("timestamp_ntz")).drop("w")
    feats = history.select("store_id", "week", F.lit(1).alias("store_lines"), F.lit(0.0).alias("avg_discount"))
    last = F.lit("2024-01-08").cast("timestamp_ntz")
    state = {r["store_id"]: r for r in series_state(history, last).collect()}
    assert state[1]["lag_1"] == 7.0 and state[1]["lag_2"] == 5.0
    assert state[2]["lag_1"] is None and state[2]["lag_2"] == 3.0
    out = predict_horizon(_LastWeekPlusTen(), series_state(history, last), feats, last)
    got = {(r["store_id"], str(r["week"])[:10]): r["forecast"] for r in out.collect()}
    weeks = ["2024-01-15", "2024-01-22", "2024-01-29", "2024-02-05"]
    assert [got[(1, w)] for w in weeks] == [17.0, 27.0, 37.0, 47.0]
    # nothing sold last week: clipped to zero, and that zero is known a week later
    assert [got[(2, w)] for w in weeks] == [0.0, 10.0, 20.0, 30.0]
