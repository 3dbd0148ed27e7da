"""The phi_k correlation between columns of any kind.

Chi-squared of two binned columns is turned into the correlation that a
bivariate normal, binned into as many rows and columns, would need for the same
chi-squared. Steps for a table of ``r`` by ``k`` values and ``n`` rows:

- below the noise pedestal ``(r-1)(k-1)`` the coefficient is 0, at the largest
  possible ``n min(r-1, k-1)`` it is 1;
- else it solves ``b(rho) / b(1) = (chi2 - pedestal) / (largest - pedestal)``,
  with ``b(rho)`` chi-squared per row of the normal on uniform bins of [-5, 5].

Contingency counts are made in Spark in one pass; only one row per pair of
columns comes back to be solved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 5.0  # the normal is binned on [-RANGE, RANGE]
STEPS = 4000  # points of the integral along the first axis
BINS = 10  # equal-width bins of a numeric column
HALVINGS = 50

_PHI = np.frompyfunc(lambda z: 0.5 * math.erfc(-z / math.sqrt(2.0)), 1, 1)


@lru_cache(maxsize=64)
def _axis(r: int, k: int) -> tuple[np.ndarray, ...]:
    """Points, their weights and rows; edges of the columns; cells of independent axes."""
    x = -RANGE + (np.arange(STEPS) + 0.5) * (2 * RANGE / STEPS)
    edges_r, edges_k = (np.linspace(-RANGE, RANGE, m + 1) for m in (r, k))
    row = np.minimum(((x + RANGE) * r / (2 * RANGE)).astype(int), r - 1)
    weight = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * (2 * RANGE / STEPS)
    margin = [np.diff(_PHI(e).astype(float)) for e in (edges_r, edges_k)]
    # the midpoint rule does not end at the edges of a bin: rows are scaled to their exact mass
    weight *= (margin[0] / np.bincount(row, weights=weight, minlength=r))[row]
    return x, weight, row, edges_k, np.outer(*margin)


@lru_cache(maxsize=4096)
def normal_chi2(rho: float, r: int, k: int) -> float:
    """Chi-squared per row of a bivariate normal of correlation ``rho`` on r by k uniform bins."""
    x, weight, row, edges, apart = _axis(r, k)
    if rho >= 1.0:
        share = -np.diff((x[:, None] > edges[None, :]).astype(float), axis=1)  # all mass lies on the diagonal
    else:
        s = math.sqrt(1.0 - rho * rho)
        share = np.diff(_PHI((edges[None, :] - rho * x[:, None]) / s).astype(float), axis=1)
    together = np.zeros((r, k))
    np.add.at(together, row, share * weight[:, None])
    return float(((together - apart) ** 2 / apart).sum())


def from_chi2(chi2: float | None, n: int, r: int, k: int) -> float | None:
    """phi_k of a table; None where one of the columns has a single value."""
    if chi2 is None or min(r, k) < 2:
        return None
    pedestal, largest = (r - 1) * (k - 1), n * min(r - 1, k - 1)
    if chi2 <= pedestal:
        return 0.0
    if chi2 >= largest:
        return 1.0
    goal = (chi2 - pedestal) / (largest - pedestal) * normal_chi2(1.0, r, k)
    low, high = 0.0, 1.0
    for _ in range(HALVINGS):
        mid = (low + high) / 2
        low, high = (mid, high) if normal_chi2(mid, r, k) < goal else (low, mid)
    return (low + high) / 2


def binned(df: DataFrame, numeric: Sequence[str], bins: int = BINS) -> DataFrame:
    """Numeric columns as numbers of equal-width bins between their least and
    largest value (NULL and NaN stay out)."""
    if not numeric:
        return df
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in numeric}
    ends = df.agg(*[f(x[c]).alias(f"{name}_{i}") for i, c in enumerate(numeric) for name, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for i, c in enumerate(numeric):
        lo, hi = ends[f"lo_{i}"], ends[f"hi_{i}"]
        if lo is None or hi <= lo:
            out[c] = F.when(x[c].isNotNull(), F.lit(0))
        else:
            out[c] = F.least(F.floor((x[c] - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
    return df.withColumns(out)


def phi_k(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """``col_a, col_b, n, r, k, chi2, phi_k`` for each pair of columns, over the rows
    where both have a value."""
    columns = [*categorical, *numeric]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    text = binned(df.select(*columns), numeric, bins).select(*[F.col(c).cast("string").alias(c) for c in columns])
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs]))
    long = text.select(cells.alias("c")).select("c.*").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    table = long.groupBy("col_a", "col_b", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    # margins from the table of counts: a few rows for each pair of values, hashed by value
    rows = table.groupBy("col_a", "col_b", "a").agg(F.sum("o").alias("ra"))
    cols = table.groupBy("col_a", "col_b", "b").agg(F.sum("o").alias("cb"))
    joined = table.join(rows, ["col_a", "col_b", "a"]).join(cols, ["col_a", "col_b", "b"])
    inner = joined.groupBy("col_a", "col_b").agg(F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("q"))
    n_rows = rows.groupBy("col_a", "col_b").agg(F.count(F.lit(1)).alias("r"))
    n_cols = cols.groupBy("col_a", "col_b").agg(F.count(F.lit(1)).alias("k"))
    per_pair = inner.join(n_rows, ["col_a", "col_b"]).join(n_cols, ["col_a", "col_b"])
    out = []
    for x in per_pair.select("*", (F.col("n") * (F.col("q") - 1)).alias("chi2")).collect():  # a row a pair of columns
        out.append((x["col_a"], x["col_b"], x["n"], x["r"], x["k"], x["chi2"], from_chi2(x["chi2"], x["n"], x["r"], x["k"])))
    return df.sparkSession.createDataFrame(out, "col_a string, col_b string, n long, r long, k long, chi2 double, phi_k double")
