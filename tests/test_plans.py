"""Plan shape checks on the flagship: no Expand, no Python, no cartesian."""

from featuremart.plans.batch_features import build_batch_features
from featuremart.sources.standins import standin_sources
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_is_jvm_only(spark):
    df = build_batch_features(standin_sources(spark, SF_SMALL))
    plan = _plan(df)
    for bad in ("Expand", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_scans_are_pruned(spark):
    df = build_batch_features(standin_sources(spark, SF_SMALL))
    plan = _plan(df)
    # the events scan reads only the five columns the stand-in needs
    assert "value" not in [c.strip() for c in plan.split("ReadSchema: struct<")[1].split(">")[0].split(",")]


BAD_EVERYWHERE = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# builders that write or stream at construction time are covered by their own tests
# (likewise those that fit models there and return a few rows without a plan)
SIDE_EFFECTS = {"features_csv_roundtrip", "features_parquet_roundtrip", "job_manifest", "stream_clean_events", "rbf_ring", "phi_k"}


def _checked_names():
    import __spark_entry__ as entry

    return sorted(n for n in entry.oracle_sql() if n not in SIDE_EFFECTS)


import pytest  # noqa: E402


@pytest.mark.parametrize("name", _checked_names())
def test_no_cartesian_or_python_in_any_plan(spark, name):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for bad in BAD_EVERYWHERE:
        assert bad not in plan, (name, bad)
