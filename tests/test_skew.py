"""The flagship under skew: one customer owns a third of all events, another
slice sits in NULL sessions (the hot key of the null-safe join). The result
must still equal the independent DuckDB computation on the same inputs."""

import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from featuremart.catalog.common import CLEAN_CTES, FEATURE_CTES, with_ctes
from featuremart.catalog.core import FEATURE_SELECT
from featuremart.plans.batch_features import build_batch_features
from featuremart.session import shared_dir
from featuremart.sources.standins import standin_sources
from featuremart.sources.tables import load_sources
from tests.conftest import SF_SMALL
from tools.oracle_check import _rows

HOT_CUSTOMER = 7


@pytest.fixture(scope="module")
def skewed_paths(spark):
    src = standin_sources(spark, SF_SMALL)
    hot_session = src.sessions.where(F.col("customer_id") == HOT_CUSTOMER).agg(F.min("session_id")).first()[0]
    bucket = F.col("event_id") % 6
    events = src.events.withColumn(
        "session_id",
        F.when(bucket < 2, F.lit(hot_session))  # a third of all events
        .when(bucket == 2, F.lit(None).cast("long"))  # a sixth in NULL sessions
        .otherwise(F.col("session_id")),
    )
    null_session = src.sessions.limit(1).select(
        F.lit(None).cast("long").alias("session_id"), F.lit(3).cast("long").alias("customer_id"), "start_time"
    )
    sessions = src.sessions.unionByName(null_session)
    base = f"{shared_dir(spark)}/featuremart-test/skew-{uuid.uuid4().hex}"
    paths = {}
    for name, df in (("customers", src.customers), ("sessions", sessions), ("events", events), ("orders", src.orders)):
        paths[name] = f"{base}/{name}"
        df.write.parquet(paths[name])
    return paths


def test_flagship_matches_oracle_under_skew(spark, skewed_paths):
    got = build_batch_features(load_sources(spark, "2024-01-25", skewed_paths))
    con = duckdb.connect()
    for name in ("customers", "sessions", "events", "orders"):
        con.execute(f"CREATE VIEW src_{name} AS SELECT * FROM read_parquet('{skewed_paths[name]}/*.parquet')")
    want = con.execute(with_ctes(CLEAN_CTES, FEATURE_CTES, select=FEATURE_SELECT)).df()
    from featuremart.catalog.core import FEATURE_DIGITS
    from featuremart.catalog.common import rounded

    got_pd = rounded(got, FEATURE_DIGITS).toPandas()
    assert len(got_pd) == len(want)
    assert _rows(got_pd) == _rows(want)
    hot = got.where(F.col("customer_id") == HOT_CUSTOMER).first()
    assert hot["page_view_30"] > 0
