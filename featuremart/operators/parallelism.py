"""Spread CPU-heavy per-row work when the input arrives in too few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_for_cpu(df: DataFrame, partitions: int | None, key: str | None = None) -> DataFrame:
    """Repartition ``df`` where the caller asks for it (``partitions`` not None).

    A large input arrives in many splits and needs nothing. A few big
    unsplittable files would leave one task to do per-row work such as
    tokenising whole texts; the caller knows its files. With a unique ``key``
    the rows are hash-partitioned on it, which is deterministic on retry
    without the full sort that a retry-safe round-robin needs.
    """
    if partitions is None:
        return df
    return df.repartition(partitions, key) if key else df.repartition(partitions)
