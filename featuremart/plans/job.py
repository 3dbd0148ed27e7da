"""Build-and-publish job, result manifest and validation of the written result.

The feature frame is computed and written once; the manifest's row count is
observed while it is written. The target is
any Hadoop-compatible URI (``s3a://bucket/prefix`` on a cluster, a local
folder in tests); executors write their parts in parallel.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.columns import ts_literal
from featuremart.plans.backfill import build_many
from featuremart.plans.batch_features import DEFAULT_WINDOWS, build_batch_features, feature_columns
from featuremart.session import stored
from featuremart.sources.tables import Sources, clean_sources, load_sources, parse_run_date

FORMATS = ("csv", "parquet")


def run_date_label(run_date: dt.datetime) -> str:
    """Path label of a run: the date alone when the run is at midnight."""
    if run_date.time() == dt.time(0):
        return run_date.strftime("%Y-%m-%d")
    return run_date.isoformat(sep=" ")


def output_path(base: str, run_date: dt.datetime) -> str:
    # some file systems forbid colons; %3A is read back as one
    return f"{base.rstrip('/')}/run_date={run_date_label(run_date).replace(':', '%3A')}"


def _for_csv(features: DataFrame, run_date: dt.datetime) -> DataFrame:
    """CSV text for run_date: ``yyyy-MM-dd`` at midnight, like the published files."""
    fmt = "yyyy-MM-dd" if run_date.time() == dt.time(0) else "yyyy-MM-dd HH:mm:ss"
    return features.withColumn("run_date", F.date_format("run_date", fmt))


def save_features(
    features: DataFrame,
    run_date: dt.datetime,
    base: str,
    fmt: str = "csv",
    single_file: bool = False,
) -> tuple[str, int]:
    """Overwrite ``<base>/run_date=<d>/`` with the features; return (path, rows).

    The run date stays inside the files as well as in the path. Rerunning a
    date replaces only that date's folder. ``single_file`` coalesces to one
    part for small consumers; leave it off at scale.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    path = output_path(base, run_date)
    seen = Observation()
    out = features if fmt == "parquet" else _for_csv(features, run_date)
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path, seen.get["rows"]


def run_job(
    spark: SparkSession,
    run_date: str | dt.datetime,
    out: str,
    sources: Sources | None = None,
    paths: Mapping[str, str] | None = None,
    source_format: str = "parquet",
    source_options: Mapping[str, str] | None = None,
    fmt: str = "csv",
    windows: Sequence[int] = DEFAULT_WINDOWS,
) -> dict:
    """Read sources, build features, write them, return the manifest."""
    rd = parse_run_date(run_date)
    src = sources or load_sources(spark, rd, paths, source_format, source_options)
    features = build_batch_features(src, windows)
    path, rows = save_features(features, rd, out, fmt)
    return {"run_date": run_date_label(rd), "rows": rows, "path": path, "format": fmt}


def read_features(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    return spark.read.parquet(path)


def validate(spark: SparkSession, manifest: Mapping, windows: Sequence[int] = DEFAULT_WINDOWS) -> None:
    """Reject an empty, missing or incomplete result.

    Raises ``ValueError`` when the manifest reports no rows or columns are
    missing, ``FileNotFoundError`` when nothing readable is at the path.
    """
    if int(manifest["rows"]) <= 0:
        raise ValueError(f"no rows were written to {manifest['path']}")
    try:
        written = read_features(spark, manifest["path"], manifest.get("format", "csv"))
        missing = [c for c in feature_columns(windows) if c not in written.columns]
        present = written.limit(1).count() > 0
    except AnalysisException as error:
        raise FileNotFoundError(f"Feature output was not found: {manifest['path']}") from error
    if missing:
        raise ValueError(f"Saved features lack columns {missing}")
    if not present:
        raise ValueError(f"no rows can be read from {manifest['path']}")


def read_feature_history(
    spark: SparkSession, base: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """All written parquet run dates under ``base``.

    ``run_date`` is discovered from the ``run_date=<d>`` folders (a date), so
    a range filter prunes folders before any file is opened.
    """
    df = spark.read.parquet(base)
    if start:
        df = df.where(F.col("run_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("run_date") <= F.lit(end).cast("date"))
    return df


def run_backfill(
    spark: SparkSession,
    run_dates: Sequence[str | dt.datetime],
    out: str,
    paths: Mapping[str, str] | None = None,
    source_format: str = "parquet",
    source_options: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    windows: Sequence[int] = DEFAULT_WINDOWS,
    sources: Sources | None = None,
) -> list[dict]:
    """Features of all run dates from one pass over the facts, each written to its
    own folder.

    The earliest copy of a row wins for every date, so the clean tables as of
    the latest date serve all of them. Their features are made together
    (:func:`featuremart.plans.backfill.build_many`) and stored once; the loop
    only writes each date's part. A failed date can be rerun alone (its folder
    is overwritten).
    """
    dates = [parse_run_date(rd) for rd in run_dates]
    if not dates:
        return []
    last = max(dates)
    if sources is None:
        sources = load_sources(spark, last, paths, source_format, source_options)
    whole = clean_sources(Sources(sources.customers, sources.sessions, sources.events, sources.orders, last))
    together = stored(build_many(whole, dates, windows), "backfill")
    manifests = []
    for rd in dates:
        path, rows = save_features(together.where(F.col("run_date") == ts_literal(rd)), rd, out, fmt)
        manifests.append({"run_date": run_date_label(rd), "rows": rows, "path": path, "format": fmt})
    return manifests
