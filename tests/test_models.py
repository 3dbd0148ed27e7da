"""Model checks run end to end on sf0.001 and return sane shapes."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

QUERIES = entry.queries()


@pytest.mark.parametrize(
    "name,min_rows",
    [("select_k_best", 8), ("model_reload", 1), ("forecast_model", 1), ("importance", 5), ("platt", 1)],
)
def test_model_checks_run(spark, name, min_rows):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= min_rows


def test_reloaded_model_agrees(spark):
    row = QUERIES["model_reload"](spark, SF_SMALL).collect()[0]
    assert row["rows"] > 0 and row["agreeing"] == row["rows"]


def test_platt_probabilities_in_range(spark):
    rows = QUERIES["platt"](spark, SF_SMALL).collect()
    assert all(0.0 <= r["mean_calibrated"] <= 1.0 for r in rows)


def test_all_model_checks_in_one_session(spark):
    """One after another, with those of the tests above: what an earlier fit leaves
    behind does not stop a later one."""
    names = ["multiclass_models", "time_cv", "cancel_model", "cancel_policy", "ordered_boosting"]
    rows = {n: QUERIES[n](spark, SF_SMALL).collect() for n in names}
    assert {r["model"] for r in rows["multiclass_models"]} == {"logreg", "linear_svc", "rbf_svc"}
    assert len(rows["time_cv"]) == 5 and len(rows["cancel_policy"]) == 2 and len(rows["cancel_model"]) == 2


def test_adaptive_search_does_less_than_the_grid(spark):
    rows = QUERIES["adaptive_search"](spark, SF_SMALL).collect()
    settings = {(r["reg_param"], r["elastic_net"]) for r in rows}
    assert len(settings) == 9 and sum(r["share"] for r in rows) < 9
    assert sum(r["kept"] for r in rows if r["share"] == 1.0) == 1
