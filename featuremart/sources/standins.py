"""Source tables derived from the driver's test tables.

The test data is a TPC-H-like star plus an ``events`` stream; these
functions map it onto the four source tables the feature build expects.
All mappings are column expressions over the given tables, so their work
grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.sources.tables import Sources, parse_run_date

# Fixed values of the stand-in mapping.
RUN_DATE = "2024-01-25"
SIGNUP_DATE = "2020-01-01 00:00:00"
ORDER_SHIFT_DAYS = 8217  # moves the latest test order to 2024-01-30
ORDER_MINUTE_SPREAD = 1440
BAD_TOTAL_EVERY = 97
DUPLICATE_EVENT_EVERY = 50
EVENT_TYPE_MAP = {"view": "page_view", "click": "add_to_cart"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_events(ev: DataFrame) -> DataFrame:
    """Renamed events of the test table, one row per input row (batch or stream)."""
    etype = F.col("event_type")
    mapped = etype
    for src, dst in EVENT_TYPE_MAP.items():
        mapped = F.when(etype == src, F.lit(dst)).otherwise(mapped)
    return ev.select(
        F.col("event_id"),
        (F.col("user_id") * 1000 + F.dayofyear("ts")).alias("session_id"),
        F.col("ts").alias("timestamp"),
        mapped.alias("event_type"),
        F.when(etype == "error", F.lit(None).cast("string"))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("product_id"),
        F.col("user_id"),
    )


def with_copies(ev: DataFrame) -> DataFrame:
    """Events with an exact second copy of every 50th event id (exercises dedupe)."""
    copies = F.when(F.col("event_id") % DUPLICATE_EVENT_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return ev.withColumn("_copy", F.explode(copies)).drop("_copy", "user_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(map_events(table(spark, sf_dir, "events")))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per session id over all events, before any product filter."""
    ev = map_events(table(spark, sf_dir, "events"))
    return ev.groupBy("session_id").agg(
        F.min("user_id").alias("customer_id"), F.min("timestamp").alias("start_time")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.lit(SIGNUP_DATE).cast("timestamp_ntz").alias("signup_date"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    shifted = F.timestamp_add(
        "MINUTE",
        (F.col("o_orderkey") % ORDER_MINUTE_SPREAD).cast("int"),
        F.timestamp_add("DAY", F.lit(ORDER_SHIFT_DAYS), F.col("o_orderdate")),
    )
    total = F.when(F.col("o_orderkey") % BAD_TOTAL_EVERY == 0, F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        shifted.alias("order_time"),
        total.alias("total_usd"),
    )


def standin_sources(spark: SparkSession, sf_dir: str, run_date: str | dt.datetime = RUN_DATE) -> Sources:
    return Sources(
        customers=customers(spark, sf_dir),
        sessions=sessions(spark, sf_dir),
        events=events(spark, sf_dir),
        orders=orders(spark, sf_dir),
        run_date=parse_run_date(run_date),
    )
