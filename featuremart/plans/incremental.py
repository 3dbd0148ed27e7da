"""Daily feature builds that do not read the history of the facts again.

A state folder keeps, for each fact table, its clean rows with their day and
version, an index of seen keys with the day of their kept row, and per day the
partial aggregates that features are made of. A batch of new rows is deduplicated, its keys are
looked up in the index, and only the days that gain or lose a row are written
anew: a late copy that is earlier than the kept one re-opens the day of either.
Features of a run date add up the partials of the days in its windows; what
reaches back further (session spans, last orders) is a running state per run
date, moved on from the latest one that no re-opened day has made stale.

A batch writes one folder a table, ordered by day, so that reading a range of
days skips what lies outside by the files' statistics. A day's rows are those of
the latest version that wrote it. Everything becomes visible by one appended
commit, so a batch that was lost half-way leaves no trace and is run again;
a batch that is committed is not applied twice. There is one writer at a time.

Read per run: the index (key and day), the touched days, the partials of the
widest window, the owner of every session, and the states. Sizes on the driver:
one row per table, day and batch that wrote it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.columns import days_between, in_window, lenient_double, ts_literal, window_start
from featuremart.operators.constants import COUNTED_TYPES, DEFAULT_WINDOWS, LENGTH_WINDOW, ORDER_WINDOW
from featuremart.operators.dedupe import dedupe_by_key
from featuremart.operators.events import event_window_features
from featuremart.operators.sessions import session_features
from featuremart.plans.batch_features import assembled
from featuremart.plans.job import run_date_label, save_features
from featuremart.sources.tables import DEDUPE_KEY, SOURCE_COLUMNS, TIME_COLUMN, _as_ntz, _check_columns, parse_run_date

NO_DAY = "none"  # day of rows without a time
COMMIT = "seq long, batch string, name string, day string, path string"


class FeatureState:
    """The state below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ---- commits

    def commits(self) -> list:
        try:
            return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits").collect()
        except AnalysisException:
            return []  # nothing committed yet

    @staticmethod
    def _next(commits: Sequence) -> int:
        return max((c["seq"] for c in commits), default=0) + 1

    def _commit(self, seq: int, batch: str, entries: Sequence[tuple[str, str, str]]) -> None:
        rows = [(seq, batch, *e) for e in entries] or [(seq, batch, "", "", "")]
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}/{uuid.uuid4().hex}"

    def _stored(self, name: str, rows: DataFrame) -> DataFrame:
        folder = self._folder(name)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _read(self, paths: Sequence[str], schema: str | T.StructType) -> DataFrame:
        """The rows of some folders (no rows if there are none)."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _days(self, commits: Sequence, name: str, schema: T.StructType, days: Sequence[str] | None = None, since: str = "", until: str = "~") -> DataFrame:
        """Current rows of a table for some days, or those from ``since`` to before ``until``."""
        mine = [c for c in commits if c["name"] == name and since <= c["day"] < until and (days is None or c["day"] in set(days))]
        latest: dict[str, int] = {}
        for c in mine:
            latest[c["day"]] = max(c["seq"], latest.get(c["day"], 0))
        current = [c for c in mine if c["seq"] == latest[c["day"]]]
        versioned = T.StructType([*schema.fields, T.StructField("day", T.StringType()), T.StructField("seq", T.LongType())])
        rows = self._read(sorted({c["path"] for c in current}), versioned)
        rows = rows.where(F.col("day").isin(list(days))) if days is not None else rows.where((F.col("day") >= since) & (F.col("day") < until))
        paths = {c["path"] for c in current}
        if any(c["path"] in paths and c["seq"] < latest[c["day"]] for c in mine):  # older versions in the same folders
            # one row a day of the calendar
            valid = self.spark.createDataFrame(sorted(latest.items()), "day string, seq long")
            rows = rows.join(F.broadcast(valid), ["day", "seq"], "left_semi")
        return rows.select(*schema.names)

    def _write_days(self, name: str, rows: DataFrame, days: Sequence[str], seq: int) -> list[tuple[str, str, str]]:
        """New versions of ``days``; ``rows`` have a column ``day``."""
        folder = self._folder(name)
        versioned = rows.withColumn("seq", F.lit(seq).cast("long"))
        versioned.select(*[c for c in rows.columns if c != "day"], "day", "seq").sortWithinPartitions("day").write.parquet(folder)
        return [(name, d, folder) for d in days]

    # ---- batches

    def ingest(self, batch: str, tables: Mapping[str, DataFrame]) -> bool:
        """Apply new rows of ``sessions``, ``events``, ``orders`` (any of them);
        False if ``batch`` is committed already."""
        commits = self.commits()
        if any(c["batch"] == batch for c in commits):
            return False
        entries: list[tuple[str, str, str]] = []
        for name in DEDUPE_KEY:
            if name in tables:
                entries += self._apply(commits, name, tables[name])
        self._commit(self._next(commits), batch, entries)
        return True

    def _apply(self, commits: Sequence, name: str, df: DataFrame) -> list[tuple[str, str, str]]:
        key, time, seq = DEDUPE_KEY[name], TIME_COLUMN[name], self._next(commits)
        _check_columns(name, df)
        rows = _as_ntz(df.select(*SOURCE_COLUMNS[name]), time)
        schema = rows.schema
        order = [time, *[c for c in schema.names if c not in (key, time)]]
        day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY))
        new = self._stored(f"{name}-new", dedupe_by_key(rows, key, [time]).withColumn("day", day))

        entry = T.StructType([schema[key], T.StructField("day", T.StringType()), T.StructField("seq", T.LongType())])
        index = self._read([c["path"] for c in commits if c["name"] == f"{name}-index"], entry)
        index = index.select(F.col(key).alias("_k"), F.col("day").alias("_day"), "seq")
        seen = new.select(F.col(key).alias("_n")).join(index, F.col("_n").eqNullSafe(F.col("_k")))
        # a key that moved has more than one entry: the last one holds
        seen = seen.groupBy("_k").agg(F.max(F.struct("seq", "_day")).alias("_at")).select("_k", "_at._day")
        seen = self._stored(f"{name}-seen", seen)
        days_seen = [r["_day"] for r in seen.select("_day").distinct().collect()]  # bounded by the calendar

        kept = self._days(commits, name, schema, days_seen).select(F.col(key).alias("_k"), F.struct(*order).alias("_kept"), day.alias("_day"))
        kept = kept.join(seen.select(F.col("_k").alias("_s")), F.col("_k").eqNullSafe(F.col("_s")), "left_semi")
        judged = new.join(kept, new[key].eqNullSafe(kept["_k"]), "left").where(F.col("_kept").isNull() | (F.struct(*order) < F.col("_kept")))
        gained = self._stored(f"{name}-gained", judged.select(*schema.names, "day", F.col("_day").alias("left_day")))

        moves = gained.select("day", "left_day").distinct().collect()  # bounded by the calendar
        touched = sorted({r["day"] for r in moves} | {r["left_day"] for r in moves if r["left_day"]})
        if not touched:
            return []
        lost = gained.where("left_day is not null").select(F.col(key).alias("_lost"))
        old = self._days(commits, name, schema, touched).join(lost, F.col(key).eqNullSafe(F.col("_lost")), "left_anti")
        entries = self._write_days(name, old.withColumn("day", day).unionByName(gained.select(*schema.names, "day")), touched, seq)
        index_path = self._folder(f"{name}-index")
        gained.select(key, "day", F.lit(seq).cast("long").alias("seq")).write.parquet(index_path)
        written = self._read([entries[0][2]], schema)
        return [*entries, (f"{name}-index", "", index_path), *self._partials(name, written, touched, seq)]

    def _partials(self, name: str, rows: DataFrame, days: Sequence[str], seq: int) -> list[tuple[str, str, str]]:
        if name == "events":
            rows = rows.where(F.col("product_id").isNotNull() & F.col("timestamp").isNotNull())
            rows = rows.groupBy("session_id", "product_id", F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(
                *[F.count_if(F.col("event_type") == t).alias(t) for t in COUNTED_TYPES],
                F.count(F.lit(1)).alias("any"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
            )
            return self._write_days("event-days", rows, days, seq)
        if name == "orders":
            usd = lenient_double("total_usd", rows.schema["total_usd"].dataType)
            rows = rows.where(F.col("customer_id").isNotNull() & F.col("order_time").isNotNull())
            rows = rows.groupBy("customer_id", F.date_format("order_time", "yyyy-MM-dd").alias("day")).agg(
                F.count(F.lit(1)).alias("n"), F.sum(usd).alias("usd"), F.max("order_time").alias("last_order_time")
            )
            return self._write_days("order-days", rows, days, seq)
        return []

    # ---- features

    def _running(self, commits: Sequence, name: str, source: str, source_schema: T.StructType, until: str, columns: Sequence[str], merge) -> DataFrame:
        """The state ``name`` of all days before ``until``: from the latest stored one
        that is younger than every day it covers, moved on by the days since."""
        written: dict[str, int] = {}
        for c in commits:
            if c["name"] == source:
                written[c["day"]] = max(c["seq"], written.get(c["day"], 0))
        stored_at = [c for c in commits if c["name"] == name and c["day"] <= until]
        fresh = [c for c in stored_at if all(s < c["seq"] for d, s in written.items() if d < c["day"])]
        start = max(fresh, key=lambda c: (c["day"], c["seq"]), default=None)
        schema = T.StructType([source_schema[c] for c in columns])
        if start is not None and start["day"] == until:
            return self._read([start["path"]], schema)
        state = self._days(commits, source, source_schema, since=start["day"] if start is not None else "", until=until).select(*columns)
        if start is not None:
            state = state.unionByName(self._read([start["path"]], schema))
        path = self._folder(name)
        merge(state).select(*columns).write.parquet(path)
        now = self._next(self.commits())
        self._commit(now, f"{name}:{until}:{now}", [(name, until, path)])
        return self._read([path], schema)

    def features(self, customers: DataFrame, run_date: str | dt.datetime, windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill_conversions: bool = False) -> DataFrame:
        """The feature frame of a run date at midnight, equal to a full build over
        all rows ingested so far."""
        run = parse_run_date(run_date)
        if run.time() != dt.time(0):
            raise ValueError("daily partials hold whole days: run_date must be at midnight")
        until = run_date_label(run)
        since = run_date_label(window_start(run, max([*windows, LENGTH_WINDOW, ORDER_WINDOW])))
        commits = self.commits()
        sessions_schema, event_day, order_day = self._schemas(commits)

        spans = self._running(
            commits, "span-state", "event-days", event_day, until, ["session_id", "first_ts", "last_ts"],
            lambda df: df.groupBy("session_id").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")),
        )
        last_orders = self._running(
            commits, "order-state", "order-days", order_day, until, ["customer_id", "last_order_time"],
            lambda df: df.groupBy("customer_id").agg(F.max("last_order_time").alias("last_order_time")),
        )

        sums = []
        for n in windows:
            inside = in_window("first_ts", run, n)
            sums += [F.sum(F.when(inside, F.col(t)).otherwise(0)).alias(f"{t}_{n}") for t in COUNTED_TYPES]
            sums.append(F.sum(F.when(inside, F.col("any")).otherwise(0)).alias(f"any_{n}"))
        rollup = self._days(commits, "event-days", event_day, since=since, until=until).groupBy("session_id", "product_id").agg(*sums)
        sessions = self._days(commits, "sessions", sessions_schema, until=until)
        events_f = event_window_features(rollup, sessions, windows)

        recent = self._days(commits, "sessions", sessions_schema, since=since, until=until)
        spans = spans.select("session_id", F.col("first_ts").alias("session_start"), F.col("last_ts").alias("session_end"))
        sessions_f = session_features(recent, spans, run, windows)

        per_day = self._days(commits, "order-days", order_day, since=run_date_label(window_start(run, ORDER_WINDOW)), until=until)
        in_range = per_day.groupBy("customer_id").agg(F.sum("n").alias(f"orders_{ORDER_WINDOW}"), F.sum("usd").alias(f"sum_total_usd_{ORDER_WINDOW}"))
        orders_f = last_orders.join(in_range, "customer_id", "left").select(
            "customer_id", days_between("last_order_time", ts_literal(run)).alias("days_since_last_purchase"), f"orders_{ORDER_WINDOW}",
            f"sum_total_usd_{ORDER_WINDOW}", (F.col(f"sum_total_usd_{ORDER_WINDOW}") / F.col(f"orders_{ORDER_WINDOW}")).alias(f"avg_total_usd_{ORDER_WINDOW}"),
        )
        return assembled(customers, events_f, sessions_f, orders_f, run, windows, zero_fill_conversions)

    def _schemas(self, commits: Sequence) -> tuple[T.StructType, T.StructType, T.StructType]:
        """Of session rows, event days and order days, as the first batches had them."""

        def first(name: str, fallback: str) -> T.StructType:
            path = next((c["path"] for c in commits if c["name"] == name), None)
            if path is None:
                return self.spark.createDataFrame([], fallback).schema
            return self.spark.read.parquet(path).drop("day", "seq").schema

        kinds = ", ".join(f"{t} long" for t in COUNTED_TYPES)
        return (
            first("sessions", "session_id long, customer_id long, start_time timestamp_ntz"),
            first("event-days", f"session_id long, product_id string, {kinds}, any long, first_ts timestamp_ntz, last_ts timestamp_ntz"),
            first("order-days", "customer_id long, n long, usd double, last_order_time timestamp_ntz"),
        )


def run_daily(
    spark: SparkSession, state: str, batch: str, tables: Mapping[str, DataFrame], customers: DataFrame, run_date: str | dt.datetime, out: str,
    fmt: str = "parquet", windows: Sequence[int] = DEFAULT_WINDOWS,
) -> dict:
    """Apply a day's new rows, build the features of ``run_date`` and write them;
    the manifest, as :func:`featuremart.plans.job.run_job` gives it."""
    kept = FeatureState(spark, state)
    kept.ingest(batch, tables)
    run = parse_run_date(run_date)
    path, rows = save_features(kept.features(customers, run, windows), run, out, fmt)
    return {"run_date": run_date_label(run), "rows": rows, "path": path, "format": fmt}
