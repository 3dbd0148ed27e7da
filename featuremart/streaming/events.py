"""Clean arriving events incrementally.

The batch build dedupes whole tables; when events land continuously the same
cleaning (one row per ``event_id``, product-less events dropped) runs as a
streaming query. Each micro-batch keeps the earliest copy of an event and
leaves out events of earlier batches, whose ids are in a table of seen events.
No event is dropped for being late: history may arrive in any order.

A batch writes its own folders, so a batch that is tried again (after a lost
executor or a restart) overwrites what it began and adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from featuremart.operators.dedupe import dedupe_by_key
from featuremart.session import shared_dir

EVENT_COLUMNS = ("event_id", "session_id", "timestamp", "event_type", "product_id")


def _clean_batch(batch: DataFrame, batch_id: int, out: str, seen: str) -> None:
    spark = batch.sparkSession
    first = dedupe_by_key(batch.select(*EVENT_COLUMNS), "event_id", ["timestamp"]).persist()
    ids = first.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    known = spark.read.parquet(seen).where(F.col("batch") < batch_id)
    # ids outside the batch's range cannot be copies; files hold them in order
    inside = F.col("event_id").between(F.lit(ids["lo"]), F.lit(ids["hi"])) if ids["lo"] is not None else F.lit(False)
    known = known.where(F.col("event_id").isNull() | inside).select(F.col("event_id").alias("_seen"))
    fresh = first.join(known, first["event_id"].eqNullSafe(known["_seen"]), "left_anti").persist()
    fresh.select("event_id").sortWithinPartitions("event_id").write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
    fresh.where(F.col("product_id").isNotNull()).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    fresh.unpersist()
    first.unpersist()


def start_clean_events(
    spark: SparkSession,
    events: DataFrame,
    out: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append cleaned events to parquet at ``out``, one folder per batch.

    Copies of one event are matched by ``event_id`` alone, however far apart
    their event times lie; a batch reads the seen ids in the range of its own.
    ``available_now`` processes what is there
    and stops (scheduled runs); otherwise the query keeps running on a
    one-minute trigger.
    """
    ckpt = checkpoint or f"{shared_dir(spark)}/featuremart-streams/clean-events"
    seen = f"{ckpt}-seen"
    empty = spark.createDataFrame([], events.select("event_id").schema)
    empty.write.mode("overwrite").parquet(f"{seen}/batch=-1")
    query = events.writeStream.option("checkpointLocation", ckpt).foreachBatch(
        lambda batch, batch_id: _clean_batch(batch, batch_id, out, seen)
    )
    query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime="1 minute")
    return query.start()


def read_clean_events(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).select(*EVENT_COLUMNS)
