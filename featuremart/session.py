"""Spark session construction and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Session time zone is pinned so that
# timestamp_ntz arithmetic and literals never shift rows across a window
# boundary; AQE re-plans joins and splits skewed shuffle partitions.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "featuremart",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the base settings applied.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task inside the driver JVM
            conf["spark.driver.memory"] = os.environ.get("FEATUREMART_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # else fixed when the session began
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it. Only a local session
    that has none gets a private folder; on a cluster, where executors could
    not see it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="featuremart-ckpt-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: what follows
    neither plans nor computes it again, also after a lost executor."""
    path = f"{shared_dir(df.sparkSession)}/featuremart-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
