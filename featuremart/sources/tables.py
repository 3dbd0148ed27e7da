"""Reading and cleaning the four source tables.

The reader takes a format and options mapping, so the same code reads
parquet in tests and ``jdbc`` (with ``partitionColumn`` / ``lowerBound`` /
``upperBound`` / ``numPartitions`` for a parallel read) in production.
Connection secrets come in through the options mapping, never from code.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.columns import ts_literal
from featuremart.operators.dedupe import dedupe_by_key

# Columns each source must provide; anything else is pruned at the scan.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "signup_date"),
    "sessions": ("session_id", "customer_id", "start_time"),
    "events": ("event_id", "session_id", "timestamp", "event_type", "product_id"),
    "orders": ("order_id", "customer_id", "order_time", "total_usd"),
}

# Time column of each source (parsed to timestamp_ntz on load).
TIME_COLUMN: dict[str, str] = {
    "customers": "signup_date",
    "sessions": "start_time",
    "events": "timestamp",
    "orders": "order_time",
}

# Key each fact table is deduplicated on.
DEDUPE_KEY: dict[str, str] = {"sessions": "session_id", "events": "event_id", "orders": "order_id"}


def parse_run_date(value: str | dt.datetime | dt.date) -> dt.datetime:
    """Accept an ISO date or zone-less datetime; reject a zoned one."""
    if isinstance(value, dt.datetime):
        parsed = value
    elif isinstance(value, dt.date):
        parsed = dt.datetime(value.year, value.month, value.day)
    else:
        parsed = dt.datetime.fromisoformat(str(value).strip())
    if parsed.tzinfo is not None:
        raise ValueError(f"run_date must be zone-less, got {value!r}")
    return parsed


def read_table(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read one table. ``path`` None means a catalog table of that name."""
    if path is None and fmt != "jdbc":
        return spark.table(name)
    reader = spark.read.format(fmt).options(**dict(options or {}))
    return reader.load(path) if path is not None else reader.load()


def table_options(options: Mapping[str, str | Mapping[str, str]] | None, name: str) -> dict[str, str]:
    """The reader options of one source: common ones, then its own."""
    options = options or {}
    common = {k: v for k, v in options.items() if not isinstance(v, Mapping)}
    return common | dict(options.get(name) or {})


@dataclass(frozen=True)
class Sources:
    """The four raw inputs and the run timestamp."""

    customers: DataFrame
    sessions: DataFrame
    events: DataFrame
    orders: DataFrame
    run_date: dt.datetime

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


@dataclass(frozen=True)
class CleanSources:
    """Sources after parsing, dedupe, product filter and run-date cut-off."""

    customers: DataFrame
    sessions: DataFrame
    events: DataFrame
    orders: DataFrame
    run_date: dt.datetime


def load_sources(
    spark: SparkSession,
    run_date: str | dt.datetime,
    paths: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str | Mapping[str, str]] | None = None,
) -> Sources:
    """Read customers / sessions / events / orders (paths or catalog tables).

    ``options`` hold for all four; under the name of a source, a mapping adds to
    them or overrides them: ``{"url": …, "events": {"dbtable": "raw.events"}}``.
    """
    paths = paths or {}
    frames = {
        name: read_table(spark, name, paths.get(name), fmt, table_options(options, name)) for name in SOURCE_COLUMNS
    }
    return Sources(run_date=parse_run_date(run_date), **frames)


def _check_columns(name: str, df: DataFrame) -> None:
    missing = [c for c in SOURCE_COLUMNS[name] if c not in df.columns]
    if missing:
        raise ValueError(f"source {name!r} lacks columns {missing}")


def _as_ntz(df: DataFrame, column: str) -> DataFrame:
    """Parse a time column to zone-less wall time (no shift for NTZ input)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return df
    if isinstance(dtype, T.StringType):
        parsed = F.try_to_timestamp(F.col(column)).cast(T.TimestampNTZType())
        # keep the wall time written in the text, drop any zone suffix
        parsed = F.coalesce(
            F.to_timestamp_ntz(F.regexp_replace(F.col(column), r"(Z|[+-]\d{2}:?\d{2})$", "")),
            parsed,
        )
        return df.withColumn(column, parsed)
    return df.withColumn(column, F.col(column).cast(T.TimestampNTZType()))


def clean_sources(src: Sources) -> CleanSources:
    """Prune, parse times, dedupe, drop product-less events, cut at run_date.

    Order matters and is kept: dedupe first, then the product filter and the
    cut-off, so a surviving copy without product or too late drops the event.
    """
    run = ts_literal(src.run_date)
    out: dict[str, DataFrame] = {}
    for name in SOURCE_COLUMNS:
        df = src.table(name)
        _check_columns(name, df)
        df = _as_ntz(df.select(*SOURCE_COLUMNS[name]), TIME_COLUMN[name])
        if name in DEDUPE_KEY:
            t = F.col(TIME_COLUMN[name])
            # Safe before the dedupe: the earliest copy wins, so a key whose
            # winner survives the cut-off keeps that winner here, and a key
            # won by a copy without time keeps it too. Reaches the scan as a
            # pushed filter, skipping data after the run date.
            df = df.where((t < run) | t.isNull())
            df = dedupe_by_key(df, DEDUPE_KEY[name], order_by=[TIME_COLUMN[name]])
        if name == "events":
            df = df.where(F.col("product_id").isNotNull())
        if name != "customers":
            df = df.where(F.col(TIME_COLUMN[name]) < run)
        out[name] = df
    return CleanSources(run_date=src.run_date, **out)
