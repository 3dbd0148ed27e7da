"""Deterministic dedupe by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``key``: the smallest by (``order_by``, other columns).

    ``min(struct(...))`` is a plain hash aggregate with a map-side partial
    step, so a hot key (even a NULL key holding a third of the rows) shrinks
    to one row per map task before the shuffle. NULL sorts first inside the
    struct, so a copy without a time wins and is then dropped by the time
    filter. NULL keys collapse to one row, as a group.
    """
    others = [c for c in df.columns if c != key]
    ranked = list(order_by) + [c for c in others if c not in order_by]
    winner = df.groupBy(key).agg(F.min(F.struct(*ranked)).alias("_keep"))
    return winner.select(*[F.col(f"_keep.{c}").alias(c) if c != key else F.col(key) for c in df.columns])
