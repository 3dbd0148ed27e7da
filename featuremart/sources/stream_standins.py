"""The stand-in event mapping applied to a streaming read of the test events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featuremart.sources.standins import map_events, table, with_copies


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the events of ``sf_dir``, mapped like the batch stand-in.

    A file source wants a folder or a pattern: this pattern matches the table
    whether it is one file or a folder of part files."""
    schema = table(spark, sf_dir, "events").schema
    ev = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return with_copies(map_events(ev))
