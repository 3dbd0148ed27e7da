"""Daily state, last-seen products and one-pass backfills against full builds."""

import dataclasses
import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from featuremart.operators.events import event_window_features, session_product_rollup
from featuremart.operators.last_seen import advanced, last_seen, window_products
from featuremart.plans.backfill import build_many
from featuremart.plans.batch_features import build_batch_features, double_columns
from featuremart.plans.incremental import FeatureState, run_daily
from featuremart.session import shared_dir
from featuremart.sources.tables import clean_sources
from tests.fixtures import SCHEMAS, micro_sources

START = dt.datetime(2025, 4, 1)
LAST = dt.datetime(2025, 6, 10)


def random_rows(seed, n=700):
    """Sources with copies at other times, null keys, times, owners and products,
    events before their session and sessions that begin long before a window."""
    r = random.Random(seed)
    when = lambda: START + dt.timedelta(minutes=r.randrange(75 * 1440), microseconds=r.randrange(10**6))
    maybe = lambda x, p=0.03: None if r.random() < p else x
    customers = [(i, START) for i in range(12)] + [(None, START)]
    sessions, events, orders = [], [], []
    for i in range(n // 8):
        t = when()
        sessions.append((maybe(i, 0.02), maybe(r.randrange(14)), maybe(t)))
        for _ in range(r.randrange(8)):
            events.append((maybe(len(events), 0.01), maybe(i), maybe(t + dt.timedelta(hours=r.randrange(-30, 90))), r.choice(["page_view", "add_to_cart", "purchase", "search"]), maybe(r.choice("ABCD"), 0.1)))
    for i in range(n // 6):
        orders.append((maybe(i, 0.02), maybe(r.randrange(14)), maybe(when()), maybe(r.choice(["10.5", "3", "bad", "7.25"]))))
    copies = [(e[0], e[1], maybe(e[2] and e[2] + dt.timedelta(days=r.randrange(-3, 4))), e[3], maybe(e[4], 0.2)) for e in events if r.random() < 0.15]
    return {"customers": customers, "sessions": sessions + sessions[:5], "events": events + copies, "orders": orders + orders[:4]}


def sources_of(spark, rows, run_date=LAST):
    frames = {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in rows}
    return dataclasses.replace(micro_sources(spark), run_date=run_date, **frames)


def values(df):
    money = double_columns() + [c for c in df.columns if c.startswith("conversion")]
    return sorted((tuple(r) for r in df.withColumns({c: F.round(c, 9) for c in money}).collect()), key=repr)


@pytest.fixture
def base(spark):
    return f"{shared_dir(spark)}/featuremart-test/{uuid.uuid4().hex}"


def test_backfill_in_one_pass_equals_builds(spark):
    src = sources_of(spark, random_rows(1))
    dates = [START, START + dt.timedelta(days=29, hours=7), *(LAST - dt.timedelta(days=k) for k in (31, 8, 1, 0))]
    got = build_many(clean_sources(src), dates).cache()
    for d in dates:
        one = build_batch_features(dataclasses.replace(src, run_date=d))
        assert values(got.where(F.col("run_date") == F.lit(d).cast("timestamp_ntz"))) == values(one), d
    got.unpersist()


def test_backfill_lays_no_fact_out_over_its_dates(spark):
    """Thirty dates: what is exploded are two steps a window, not a row a date."""
    src = sources_of(spark, random_rows(3))
    dates = [LAST - dt.timedelta(days=k) for k in range(30)]
    plan = build_many(clean_sources(src), dates)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence(") <= 1  # the sums of money, per range and not per order


def test_last_seen_state_equals_window_features(spark):
    rows = random_rows(4)
    for run in (LAST, LAST - dt.timedelta(days=13, hours=5)):
        c = clean_sources(sources_of(spark, rows, run))
        cut = F.lit(run - dt.timedelta(days=4)).cast("timestamp_ntz")
        state = last_seen(c.events.where(F.col("timestamp") < cut), c.sessions)
        state = advanced(state, last_seen(c.events.where(F.col("timestamp") >= cut), c.sessions))
        want = event_window_features(session_product_rollup(c.events, run), c.sessions).select("customer_id", "unique_products_7", "unique_products_30")
        assert values_of(window_products(state, run)) == values_of(want)


def values_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batches_of(rows, days, seed):
    """The rows as they come in day by day, some of them days late."""
    r = random.Random(seed)
    out = [{n: [] for n in ("sessions", "events", "orders")} for _ in range(days)]
    for name, at in (("sessions", 2), ("events", 2), ("orders", 2)):
        for row in rows[name]:
            day = (row[at] - START).days // 20 if row[at] else r.randrange(days)
            late = r.choice([0, 0, 0, 1, 2])
            out[max(0, min(days - 1, day + late))][name].append(row)
    return out


def test_daily_runs_equal_one_build(spark, base):
    rows = random_rows(6, 500)
    batches = batches_of(rows, 3, 1)
    state = FeatureState(spark, base)
    so_far = {"customers": rows["customers"], "sessions": [], "events": [], "orders": []}
    for k, batch in enumerate(batches):
        frames = {n: spark.createDataFrame(batch[n], SCHEMAS[n]) for n in batch}
        if k == 1:  # the run is lost after it has written, and run again
            commit = state._commit
            state._commit = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
            with pytest.raises(RuntimeError):
                state.ingest(f"batch-{k}", frames)
            state._commit = commit
        assert state.ingest(f"batch-{k}", frames)
        assert not state.ingest(f"batch-{k}", frames)  # nothing is applied twice
        for n in batch:
            so_far[n] += batch[n]
        customers = spark.createDataFrame(rows["customers"], SCHEMAS["customers"])
        for run in (START + dt.timedelta(days=20 * k + 15), LAST)[1 if k == 2 else 0 :]:
            want = build_batch_features(sources_of(spark, so_far, run))
            assert values(state.features(customers, run)) == values(want), (k, run)


def test_a_late_copy_reopens_its_day(spark, base):
    state = FeatureState(spark, base)
    sessions = spark.createDataFrame([(1, 1, dt.datetime(2025, 6, 1))], SCHEMAS["sessions"])
    event = lambda day, kind: spark.createDataFrame([(7, 1, dt.datetime(2025, 6, day, 12), kind, "A")], SCHEMAS["events"])
    customers = spark.createDataFrame([(1, START)], SCHEMAS["customers"])
    state.ingest("a", {"sessions": sessions, "events": event(8, "purchase")})
    one = state.features(customers, "2025-06-10").first()
    assert (one["purchase_7"], one["page_view_7"], one["unique_products_7"]) == (1, 0, 1)
    state.ingest("b", {"events": event(2, "page_view")})  # an earlier copy: the later one leaves its day
    one = state.features(customers, "2025-06-10").first()
    assert (one["purchase_30"], one["page_view_7"], one["page_view_30"]) == (0, 0, 1)
    state.ingest("c", {"events": event(9, "add_to_cart")})  # a later copy changes nothing
    assert tuple(state.features(customers, "2025-06-10").first()) == tuple(one)
    state.ingest("d", {"events": spark.createDataFrame([(7, 1, None, "search", "A")], SCHEMAS["events"])})
    assert state.features(customers, "2025-06-10").first()["page_view_30"] == 0  # a copy without a time wins


def test_a_daily_run_reads_the_days_of_its_windows(spark, base):
    rows = random_rows(8, 300)
    state = FeatureState(spark, base)
    state.ingest("all", {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in ("sessions", "events", "orders")})
    customers = spark.createDataFrame(rows["customers"], SCHEMAS["customers"])
    state.features(customers, LAST - dt.timedelta(days=1))
    asked = []
    keep = state._days
    state._days = lambda commits, name, *a, **k: (asked.append((name, k.get("since"))), keep(commits, name, *a, **k))[1]
    got = state.features(customers, LAST)
    assert ("event-days", "2025-05-11") in asked and ("event-days", "2025-06-09") in asked  # thirty days; the state's one
    assert {s for n, s in asked if n == "event-days"} == {"2025-05-11", "2025-06-09"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,2025-05-11)" in plan  # reaches the scan
    with pytest.raises(ValueError):
        state.features(customers, "2025-06-10 12:00:00")


def test_daily_run_writes_and_empty_state(spark, base):
    customers = spark.createDataFrame([(1, START), (None, START)], SCHEMAS["customers"])
    manifest = run_daily(spark, f"{base}/state", "none", {}, customers, "2025-06-10", f"{base}/out")
    assert manifest["rows"] == 2
    assert spark.read.parquet(manifest["path"]).agg(F.sum("page_view_30")).first()[0] == 0
