"""Checks for the batch feature path over the stand-in sources."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.catalog import register
from featuremart.catalog.common import FEATURE_CTES, STANDIN_CTES, rounded, with_ctes
from featuremart.functions.columns import ts_literal
from featuremart.operators.conversions import add_conversions, conversion_columns
from featuremart.operators.events import attribute_events, event_window_features, session_product_rollup
from featuremart.operators.last_seen import advanced, last_seen, window_products
from featuremart.operators.orders import order_features
from featuremart.operators.quantiles import exact_quantiles
from featuremart.operators.sessions import session_features, session_lengths, session_spans
from featuremart.plans.batch_features import build_from_clean, customer_spine, feature_columns
from featuremart.plans.backfill import build_many
from featuremart.plans.incremental import FeatureState
from featuremart.plans.job import read_features, run_job, validate
from featuremart.session import shared_dir, stored
from featuremart.sources.standins import standin_sources, table
from featuremart.sources.tables import clean_sources, parse_run_date

# Means of microsecond durations end in ...5 at the 7th digit, a rounding tie
# the two engines break differently; 9 digits lies past every exact
# expansion here. Money sums are whole cents.
MEAN_DIGITS = 9
FEATURE_DIGITS = {
    "avg_session_length_30": MEAN_DIGITS,
    "sum_total_usd_30": 2,
    "avg_total_usd_30": MEAN_DIGITS,
    **{c: MEAN_DIGITS for c in conversion_columns()},
}


def _clean(spark: SparkSession, sf_dir: str):
    return clean_sources(standin_sources(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_from_clean(_clean(spark, sf_dir))


FEATURE_SELECT = "SELECT " + ", ".join(
    f"round({c}, {FEATURE_DIGITS[c]}) AS {c}" if c in FEATURE_DIGITS else c for c in feature_columns()
) + " FROM features"


@register("batch_features", with_ctes(STANDIN_CTES, FEATURE_CTES, select=FEATURE_SELECT))
def batch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_features(spark, sf_dir), FEATURE_DIGITS)


@register("clean_events", with_ctes(STANDIN_CTES, select="SELECT * FROM c_events"))
def clean_events(spark, sf_dir):
    return _clean(spark, sf_dir).events


@register("clean_sessions", with_ctes(STANDIN_CTES, select="SELECT * FROM c_sessions"))
def clean_sessions(spark, sf_dir):
    return _clean(spark, sf_dir).sessions


@register("clean_orders", with_ctes(STANDIN_CTES, select="SELECT * FROM c_orders"))
def clean_orders(spark, sf_dir):
    return _clean(spark, sf_dir).orders


@register(
    "customer_spine",
    with_ctes(STANDIN_CTES, select="SELECT DISTINCT customer_id FROM src_customers"),
)
def spine(spark, sf_dir):
    return customer_spine(_clean(spark, sf_dir).customers)


@register("users_scan", "SELECT * FROM customer")
def users_scan(spark, sf_dir):
    # the ad-hoc ``select * from users`` over a registered view
    table(spark, sf_dir, "customer").createOrReplaceTempView("users")
    return spark.sql("select * from users")


@register(
    "event_attribution",
    with_ctes(
        STANDIN_CTES,
        select="""SELECT e.*, s.customer_id FROM c_events e
                  LEFT JOIN c_sessions s ON e.session_id IS NOT DISTINCT FROM s.session_id""",
    ),
)
def event_attribution(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return attribute_events(c.events, c.sessions)


@register(
    "event_window_features",
    with_ctes(STANDIN_CTES, FEATURE_CTES, select="SELECT * FROM ev_feat"),
)
def event_window(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return event_window_features(session_product_rollup(c.events, c.run_date), c.sessions)


@register(
    "session_spans",
    with_ctes(
        STANDIN_CTES,
        FEATURE_CTES,
        select="""SELECT session_id, customer_id, start_time, session_start, session_end,
                         round(duration_seconds, 6) AS duration_seconds FROM sess_len""",
    ),
)
def spans(spark, sf_dir):
    c = _clean(spark, sf_dir)
    out = session_lengths(c.sessions, session_spans(session_product_rollup(c.events, c.run_date)))
    return rounded(out, {"duration_seconds": 6})


@register(
    "session_features",
    with_ctes(
        STANDIN_CTES,
        FEATURE_CTES,
        select="""SELECT customer_id, round(avg_session_length_30, 9) AS avg_session_length_30,
                         sessions_7, sessions_30 FROM sess_feat
                  WHERE sessions_30 > 0""",
    ),
)
def sessions_f(spark, sf_dir):
    c = _clean(spark, sf_dir)
    out = session_features(c.sessions, session_spans(session_product_rollup(c.events, c.run_date)), c.run_date)
    return rounded(out, {"avg_session_length_30": MEAN_DIGITS})


@register(
    "order_features",
    with_ctes(
        STANDIN_CTES,
        FEATURE_CTES,
        select="""SELECT customer_id, days_since_last_purchase, orders_30,
                         round(sum_total_usd_30, 2) AS sum_total_usd_30,
                         round(avg_total_usd_30, 9) AS avg_total_usd_30 FROM ord_feat""",
    ),
)
def orders_f(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return rounded(order_features(c.orders, c.run_date), {"sum_total_usd_30": 2, "avg_total_usd_30": MEAN_DIGITS})


CONVERSION_SELECT = (
    "SELECT customer_id, "
    + ", ".join(f"round({c}, 9) AS {c}" for c in conversion_columns())
    + " FROM features"
)


@register("conversion_features", with_ctes(STANDIN_CTES, FEATURE_CTES, select=CONVERSION_SELECT))
def conversions(spark, sf_dir):
    c = _clean(spark, sf_dir)
    ev = event_window_features(session_product_rollup(c.events, c.run_date), c.sessions)
    wide = customer_spine(c.customers).join(ev, "customer_id", "left")
    out = add_conversions(wide).select("customer_id", *conversion_columns())
    return rounded(out, {k: MEAN_DIGITS for k in conversion_columns()})


def _roundtrip(spark: SparkSession, sf_dir: str, fmt: str) -> tuple[dict, DataFrame]:
    base = f"{shared_dir(spark)}/featuremart-out/{uuid.uuid4().hex}"
    manifest = run_job(spark, "2024-01-25", base, sources=standin_sources(spark, sf_dir), fmt=fmt)
    return manifest, read_features(spark, manifest["path"], fmt)


CSV_SELECT = (
    "SELECT "
    + ", ".join(
        "strftime(run_date, '%Y-%m-%d') AS run_date"
        if c == "run_date"
        else (f"round({c}, {FEATURE_DIGITS[c]}) AS {c}" if c in FEATURE_DIGITS else c)
        for c in feature_columns()
    )
    + " FROM features"
)


@register("features_csv_roundtrip", with_ctes(STANDIN_CTES, FEATURE_CTES, select=CSV_SELECT))
def csv_roundtrip(spark, sf_dir):
    _, back = _roundtrip(spark, sf_dir, "csv")
    # CSV holds text; restore the contract types for comparison
    typed = back.select(
        *[
            F.col(c).cast(T.LongType()).alias(c)
            if c not in FEATURE_DIGITS and c not in ("run_date",)
            else (F.col(c) if c == "run_date" else F.col(c).cast(T.DoubleType()).alias(c))
            for c in feature_columns()
        ]
    )
    return rounded(typed, FEATURE_DIGITS)


@register("features_parquet_roundtrip", with_ctes(STANDIN_CTES, FEATURE_CTES, select=FEATURE_SELECT))
def parquet_roundtrip(spark, sf_dir):
    _, back = _roundtrip(spark, sf_dir, "parquet")
    return rounded(back, FEATURE_DIGITS)


@register(
    "job_manifest",
    "SELECT '2024-01-25' AS run_date, count(DISTINCT c_custkey) + max(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END)"
    " AS rows, 'parquet' AS format FROM customer",
)
def job_manifest(spark, sf_dir):
    manifest, _ = _roundtrip(spark, sf_dir, "parquet")
    return spark.createDataFrame(
        [(manifest["run_date"], manifest["rows"], manifest["format"])],
        "run_date string, rows long, format string",
    )


@register(
    "validate_result",
    """SELECT * FROM (VALUES ('complete', 'accepted'), ('empty', 'ValueError'), ('incomplete', 'ValueError'),
                      ('missing', 'FileNotFoundError')) t(written, outcome)
WHERE (SELECT count(*) FROM customer) > 0""",
)
def validate_result(spark, sf_dir):
    """What validation says of a complete, an empty, an incomplete and a missing result."""
    manifest, back = _roundtrip(spark, sf_dir, "parquet")
    base = manifest["path"]
    back.limit(0).write.parquet(f"{base}-empty")
    back.drop("orders_30").write.parquet(f"{base}-incomplete")
    cases = {
        "complete": manifest,
        "empty": {**manifest, "path": f"{base}-empty"},
        "incomplete": {**manifest, "path": f"{base}-incomplete"},
        "missing": {**manifest, "path": f"{base}-missing"},
    }
    out = []
    for name, m in cases.items():
        try:
            validate(spark, m)
            out.append((name, "accepted"))
        except (ValueError, FileNotFoundError) as error:
            out.append((name, type(error).__name__))
    return spark.createDataFrame(out, "written string, outcome string")


@register(
    "unique_products_state",
    with_ctes(STANDIN_CTES, FEATURE_CTES, select="SELECT customer_id, unique_products_7, unique_products_30 FROM ev_feat"),
)
def unique_products_state(spark, sf_dir):
    """Distinct products of both windows from a last-seen state: all events up to
    five days before the run date, then each day's events added to it."""
    c = _clean(spark, sf_dir)
    bounds = [c.run_date - dt.timedelta(days=k) for k in range(5, -1, -1)]
    before = lambda d: F.col("timestamp") < ts_literal(d)
    state = stored(last_seen(c.events.where(before(bounds[0])), c.sessions), "last-seen")
    for since, until in zip(bounds, bounds[1:]):
        day = last_seen(c.events.where(~before(since) & before(until)), c.sessions)
        state = stored(advanced(state, day), "last-seen")
    return window_products(state, c.run_date)


# Means over 16 sessions end in ...5 at the 10th digit; moved off that tie on both sides.
OFF_TIES = 3e-10
BACKFILL_DATES = ("2024-01-11", "2024-01-18", "2024-01-24", "2024-01-25")


def _features_sql(date: str) -> str:
    """The feature oracle of another run date: its own bounds in place of the usual ones."""
    day = dt.date.fromisoformat(date)
    bounds = {"2024-01-25": day, "2024-01-18": day - dt.timedelta(days=7), "2023-12-26": day - dt.timedelta(days=30)}
    text = with_ctes(STANDIN_CTES, FEATURE_CTES, select=FEATURE_SELECT).replace("round(avg_session_length_30,", f"round(avg_session_length_30 + {OFF_TIES},")
    for i, old in enumerate(bounds):
        text = text.replace(old, f"<{i}>")
    for i, new in enumerate(bounds.values()):
        text = text.replace(f"<{i}>", new.isoformat())
    return text


@register("backfill_features", "\nUNION ALL\n".join(f"SELECT * FROM ({_features_sql(d)})" for d in BACKFILL_DATES))
def backfill_features(spark, sf_dir):
    """Features of several run dates from one pass over the facts."""
    dates = [parse_run_date(d) for d in BACKFILL_DATES]
    clean = clean_sources(standin_sources(spark, sf_dir, max(dates)))
    out = build_many(clean, dates)
    return rounded(out.withColumn("avg_session_length_30", F.col("avg_session_length_30") + OFF_TIES), FEATURE_DIGITS)


@register("incremental_features", with_ctes(STANDIN_CTES, FEATURE_CTES, select=FEATURE_SELECT))
def incremental_features(spark, sf_dir):
    """The features from a state fed with three batches; the first batch lacks some
    early events, which arrive last and re-open their days."""
    src = standin_sources(spark, sf_dir)
    state = FeatureState(spark, f"{shared_dir(spark)}/featuremart-state/{uuid.uuid4().hex}")
    cut = ts_literal(src.run_date - dt.timedelta(days=3))
    late = F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0
    early = F.col("timestamp") < cut
    state.ingest("history", {
        "sessions": src.sessions.where(F.col("start_time") < cut), "events": src.events.where(early & ~late),
        "orders": src.orders.where(F.col("order_time") < cut),
    })
    state.features(src.customers, src.run_date - dt.timedelta(days=3))  # leaves its running states
    state.ingest("days", {
        "sessions": src.sessions.where(F.col("start_time") >= cut), "events": src.events.where(~early),
        "orders": src.orders.where(F.col("order_time") >= cut),
    })
    state.ingest("late", {"events": src.events.where(early & late)})
    return rounded(state.features(src.customers, src.run_date), FEATURE_DIGITS)


@register(
    "group_quantiles",
    """SELECT l_partkey, p, round(quantile, 6) AS quantile FROM (
  SELECT l_partkey, unnest([0.1, 0.5, 0.9]) AS p, unnest(quantile_cont(CAST(l_extendedprice AS DOUBLE), [0.1, 0.5, 0.9])) AS quantile
  FROM lineitem GROUP BY l_partkey)""",
)
def group_quantiles(spark, sf_dir):
    """Deciles of a price in every one of many groups."""
    got = exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9], by=["l_partkey"])
    return rounded(got, {"quantile": 6})
