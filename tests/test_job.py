"""Sinks, manifest and result validation."""

import re
import uuid

import pytest

from featuremart.plans.batch_features import feature_columns
from featuremart.plans.job import read_features, run_job, validate
from featuremart.session import shared_dir
from tests.fixtures import RUN, micro_sources


@pytest.fixture()
def base(spark):
    return f"{shared_dir(spark)}/featuremart-test/{uuid.uuid4().hex}"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_manifest_validate(spark, base, fmt):
    m = run_job(spark, RUN, base, sources=micro_sources(spark), fmt=fmt)
    assert m["rows"] == 4
    assert m["path"].endswith("run_date=2025-06-10")
    validate(spark, m)
    back = read_features(spark, m["path"], fmt)
    assert back.columns == feature_columns()
    assert back.count() == 4
    if fmt == "csv":
        assert {r["run_date"] for r in back.collect()} == {"2025-06-10"}
        # undefined conversions are written as empty fields
        nulls = back.where("customer_id = 2").collect()[0]["conversion_page_to_cart_7"]
        assert nulls is None


def test_rerun_overwrites(spark, base):
    run_job(spark, RUN, base, sources=micro_sources(spark), fmt="parquet")
    m = run_job(spark, RUN, base, sources=micro_sources(spark), fmt="parquet")
    assert read_features(spark, m["path"], "parquet").count() == 4


def test_validate_rejects(spark, base):
    with pytest.raises(ValueError):
        validate(spark, {"rows": 0, "path": base, "format": "csv"})
    with pytest.raises(FileNotFoundError):
        validate(spark, {"rows": 3, "path": f"{base}/missing", "format": "csv"})


def test_history_reader_prunes_run_dates(spark, base):
    import dataclasses
    import datetime as dt

    from featuremart.plans.job import read_feature_history

    for d in ("2025-06-10", "2025-06-11"):
        src = dataclasses.replace(micro_sources(spark), run_date=dt.datetime.fromisoformat(d))
        run_job(spark, d, base, sources=src, fmt="parquet")
    hist = read_feature_history(spark, base, start="2025-06-11")
    assert hist.count() == 4
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(run_date#\d+\), \(run_date#\d+ >= 2025-06-11\)\]", plan)
    assert [str(r["run_date"]) for r in hist.select("run_date").distinct().collect()] == ["2025-06-11"]
    assert read_feature_history(spark, base).count() == 8


def test_backfill_writes_one_folder_per_date(spark, base):
    from featuremart.plans.job import read_feature_history, run_backfill

    ms = run_backfill(spark, ["2025-06-09", "2025-06-10"], base, sources=micro_sources(spark))
    assert [m["run_date"] for m in ms] == ["2025-06-09", "2025-06-10"]
    assert all(m["rows"] == 4 for m in ms)
    assert read_feature_history(spark, base).select("run_date").distinct().count() == 2


def test_backfill_equals_single_runs(spark, base):
    from featuremart.plans.job import read_features, run_backfill

    dates = ["2025-05-20", "2025-06-10", "2025-06-10 12:30:00"]
    many = run_backfill(spark, dates, f"{base}/many", sources=micro_sources(spark), fmt="parquet")
    for m, d in zip(many, dates):
        assert ":" not in m["path"].removeprefix("file:")
        one = run_job(spark, d, f"{base}/one", sources=_at(spark, d), fmt="parquet")
        assert one["rows"] == m["rows"]
        a, b = (read_features(spark, x["path"], "parquet") for x in (one, m))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def _at(spark, d):
    import dataclasses
    import datetime as dt

    return dataclasses.replace(micro_sources(spark), run_date=dt.datetime.fromisoformat(d))
