"""Registered checks: each name maps to a Spark builder ``(spark, sf_dir)``
and, where SQL can say the same thing, to an independent DuckDB query over
the raw test tables. ``__spark_entry__`` exposes both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so its registrations run."""
    from featuremart.catalog import bookings, core, forecast, loyalty, marts, models, streams, usage  # noqa: F401
