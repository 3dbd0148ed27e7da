"""Ordered target statistics: categories as numbers without leaking the label.

A category is replaced by the mean label of its rows, smoothed by a prior. A
row that is in its own mean leaks its label to the model, so in training each
row only sees the rows before it in a fixed random order (a hash of its id):
``(sum of earlier labels + weight * prior) / (earlier rows + weight)``. The
prefix sums run in slices of the hash, so a category with a third of all rows
is spread over tasks. Rows to be scored later take the statistics of all
training rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.operators.sequence import SLICE_ROWS, running_sums_within

PRIOR_WEIGHT = 1.0


def permutation_key(id_col: str, seed: int = 0) -> Column:
    """Place of a row in the random order: a text hash that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _long(df: DataFrame, id_col: str, label: str, categories: Sequence[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in categories]))
    return df.where(F.col(label).isNotNull()).select(F.col(id_col), F.col(label).cast("double").alias("_y"), pairs.alias("_c")).select(id_col, "_y", "_c.*")


def _prior(df: DataFrame, label: str) -> tuple[Column, int]:
    """Mean label, and the number of rows with one."""
    got = df.agg(F.avg(F.col(label).cast("double")), F.count(label)).first()
    return F.lit(got[0]).cast("double"), got[1]


def ordered_target_statistics(
    df: DataFrame, id_col: str, label: str, categories: Sequence[str], weight: float = PRIOR_WEIGHT, seed: int = 0
) -> DataFrame:
    """``id_col`` and ``<category>_ts`` for every row with a label (ids must be
    unique). A null category is a category of its own."""
    prior, n = _prior(df, label)
    # leading hex digits of the hash that name a slice: a category of all rows stays in bounds
    digits = max(2, math.ceil(math.log(max(n, 1) / SLICE_ROWS, 16)))
    rows = _long(df, id_col, label, categories).withColumn("_at", permutation_key(id_col, seed))
    before = running_sums_within(
        rows, ["column", "value"], ["_at", id_col], {"_n": F.lit(1), "_s": F.col("_y")},
        inclusive=False, slice_by=F.substring("_at", 1, digits),
    )
    ts = (F.col("_s") + weight * prior) / (F.col("_n") + F.lit(weight))
    wide = [F.max(F.when(F.col("column") == c, ts)).alias(f"{c}_ts") for c in categories]
    return before.groupBy(id_col).agg(*wide)


def target_statistics(df: DataFrame, label: str, categories: Sequence[str], weight: float = PRIOR_WEIGHT) -> DataFrame:
    """column, value, ts of every category over all rows with a label; the row
    with neither column nor value is the prior, for values not met."""
    prior, _ = _prior(df, label)
    long = _long(df.withColumn("_id", F.lit(0)), "_id", label, categories)
    sums = long.groupBy("column", "value").agg(F.sum("_y").alias("_s"), F.count(F.lit(1)).alias("_n"))
    known = sums.select("column", "value", ((F.col("_s") + weight * prior) / (F.col("_n") + F.lit(weight))).alias("ts"))
    none = F.lit(None).cast("string")
    return known.unionByName(df.sparkSession.range(1).select(none.alias("column"), none.alias("value"), prior.alias("ts")))


def with_target_statistics(rows: DataFrame, statistics: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``rows`` with ``<category>_ts`` from :func:`target_statistics`."""
    prior = statistics.where("column is null").select("ts").first()[0]
    for c in categories:
        own = statistics.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("ts").alias(f"{c}_ts"))
        rows = rows.join(own, F.col(c).cast("string").eqNullSafe(F.col("_v")), "left").drop("_v")
        rows = rows.withColumn(f"{c}_ts", F.coalesce(f"{c}_ts", F.lit(prior).cast("double")))
    return rows
