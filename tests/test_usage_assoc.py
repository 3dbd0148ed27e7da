"""Hand-computed expectations: macro F1, category shares, χ² / Cramér's V."""

import math

import pytest

from featuremart.plans import loyalty as ly
from featuremart.plans import usage as us


def test_macro_f1_is_unweighted(spark):
    # labels 0,0,0,1 ; predictions 0,0,1,1
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1)], "label int, prediction int")
    rep = {r["class"]: r for r in us.class_report(df, "label", "prediction").collect()}
    assert rep[0]["precision"] == 1.0 and rep[0]["recall"] == pytest.approx(2 / 3)
    assert rep[1]["precision"] == 0.5 and rep[1]["recall"] == 1.0
    f0, f1 = 2 * (2 / 3) / (1 + 2 / 3), 2 * 0.5 / 1.5
    got = us.macro_f1(df, "label", "prediction").collect()[0]
    assert got["macro_f1"] == pytest.approx((f0 + f1) / 2) and got["classes"] == 2 and got["n"] == 4


def test_category_shares(spark):
    visits = spark.createDataFrame(
        [(1, "view"), (1, "view"), (1, "click"), (2, "error")], "user_id long, category string"
    ).selectExpr("user_id", "category", "current_timestamp() AS ts", "1.0 AS value")
    rows = {r["user_id"]: r for r in us.category_shares(visits, ["view", "click", "error"]).collect()}
    assert rows[1]["share_view"] == pytest.approx(2 / 3) and rows[1]["share_error"] == 0.0
    assert rows[2]["share_error"] == 1.0


def test_chi2_and_cramers_v(spark):
    # 2x2 table: (x,p)=30, (x,q)=10, (y,p)=10, (y,q)=30  →  χ² = 20, V = 0.5
    rows = [("x", "p")] * 30 + [("x", "q")] * 10 + [("y", "p")] * 10 + [("y", "q")] * 30
    prof = spark.createDataFrame(rows, "first_a string, first_b string").selectExpr(
        "*", "1.0 AS n_orders", "1.0 AS revenue_rub", "1.0 AS avg_gap_days"
    )
    out = {(r["measure"]): r["value"] for r in ly.association(prof, ["first_a", "first_b"], []).collect()}
    assert out["chi2"] == pytest.approx(20.0)
    assert out["cramers_v"] == pytest.approx(math.sqrt(20.0 / 80))
