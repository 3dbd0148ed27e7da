"""Every registered check with an oracle, against DuckDB on sf0.001."""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, _rows  # noqa: E402
from tests.conftest import SF_MID, SF_SMALL  # noqa: E402

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


# Model fits have no SQL twin; everything else must carry an oracle.
ROWS_ONLY = {
    "age_pipeline", "multiclass_models", "rfe", "grid_search",
    "cancel_model", "platt", "importance", "forecast_model", "forecast_batch", "cancel_policy", "time_cv",
    "adaptive_search", "ordered_boosting",
}


def test_every_non_model_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    # the training-data operators have tests of their own
    own = {n for n in QUERIES if re.fullmatch(r"op\d+_\w+|pipeline", n)}
    assert set(QUERIES) - set(ORACLES) - own == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", ["psi", "outlier_trim", "order_gaps", "prior_bookings", "user_profile"])
def test_ordered_queries_match_on_more_rows(spark, name):
    """Slices and brackets must not depend on how many rows are sampled."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    assert _rows(QUERIES[name](spark, SF_MID).toPandas()) == _rows(con.execute(ORACLES[name]).df())
    con.close()
