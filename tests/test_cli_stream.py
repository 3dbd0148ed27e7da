"""The command-line job and restarts of the streaming cleaner."""

import json
import uuid

from pyspark.sql import functions as F

from featuremart.cli import main
from featuremart.session import shared_dir
from featuremart.sources.stream_standins import event_stream
from featuremart.streaming.events import read_clean_events, start_clean_events
from tests.conftest import SF_SMALL
from tests.fixtures import micro_sources


def test_cli_run_writes_and_validates(spark, capsys):
    base = f"{shared_dir(spark)}/featuremart-test/cli-{uuid.uuid4().hex}"
    src = micro_sources(spark)
    paths = {}
    for name in ("customers", "sessions", "events", "orders"):
        paths[name] = f"{base}/in/{name}"
        getattr(src, name).write.parquet(paths[name])
    argv = ["run", "--run-date", "2025-06-10", "--out", f"{base}/out", "--format", "parquet"]
    for name, path in paths.items():
        argv += ["--source", f"{name}={path}"]
    assert main(argv) == 0
    manifest = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert manifest["rows"] == 4 and manifest["run_date"] == "2025-06-10"


def test_stream_restart_adds_nothing(spark):
    base = f"{shared_dir(spark)}/featuremart-test/stream-{uuid.uuid4().hex}"
    for _ in range(2):  # second run resumes from the checkpoint: no new files, no new rows
        start_clean_events(spark, event_stream(spark, SF_SMALL), f"{base}/out", f"{base}/ckpt").awaitTermination()
    out = read_clean_events(spark, f"{base}/out")
    assert out.count() == out.select("event_id").distinct().count()
    assert out.where(F.col("product_id").isNull()).count() == 0


def test_stream_keeps_history_that_comes_late(spark):
    """Files in reverse order of time, one a batch, with copies across them."""
    base = f"{shared_dir(spark)}/featuremart-test/late-{uuid.uuid4().hex}"
    schema = "event_id long, session_id long, timestamp timestamp_ntz, event_type string, product_id string"
    for k, (day, ids) in enumerate([("2024-03-01", [1, 2, None]), ("2024-01-01", [3, 4]), ("2024-03-01", [2, 5]), ("2023-01-01", [6])]):
        rows = [(i, 1, "a" if i != 4 else None) for i in ids]
        df = spark.createDataFrame(rows, "event_id long, session_id long, product_id string").selectExpr(
            "event_id", "session_id", f"cast('{day}' as timestamp_ntz) as timestamp", "'page_view' as event_type", "product_id")
        df.coalesce(1).write.parquet(f"{base}/in/part={k}")
        start_clean_events(spark, spark.readStream.schema(schema).parquet(f"{base}/in/part=*"), f"{base}/out", f"{base}/ckpt").awaitTermination()
    got = [r["event_id"] for r in read_clean_events(spark, f"{base}/out").collect()]
    assert sorted(got, key=str) == [1, 2, 3, 5, 6, None]


def test_stream_matches_copies_at_any_distance(spark):
    """A copy in another batch with a time ten days later, and one years before."""
    base = f"{shared_dir(spark)}/featuremart-test/apart-{uuid.uuid4().hex}"
    schema = "event_id long, session_id long, timestamp timestamp_ntz, event_type string, product_id string"
    for k, (day, ids) in enumerate([("2024-03-01", [1, 2]), ("2024-03-11", [2, 3]), ("2020-01-01", [1, 4])]):
        df = spark.createDataFrame([(i, 1, "a") for i in ids], "event_id long, session_id long, product_id string").selectExpr(
            "event_id", "session_id", f"cast('{day}' as timestamp_ntz) as timestamp", "'page_view' as event_type", "product_id")
        df.coalesce(1).write.parquet(f"{base}/in/part={k}")
        start_clean_events(spark, spark.readStream.schema(schema).parquet(f"{base}/in/part=*"), f"{base}/out", f"{base}/ckpt").awaitTermination()
    assert sorted(r["event_id"] for r in read_clean_events(spark, f"{base}/out").collect()) == [1, 2, 3, 4]


def test_stream_reads_a_folder_of_parts(spark):
    base = f"{shared_dir(spark)}/featuremart-test/parts-{uuid.uuid4().hex}"
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(f"{base}/events.parquet")
    for n, d in (("parts", base), ("file", SF_SMALL)):
        start_clean_events(spark, event_stream(spark, d), f"{base}/{n}", f"{base}/ckpt-{n}").awaitTermination()
    a, b = (read_clean_events(spark, f"{base}/{n}") for n in ("parts", "file"))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
