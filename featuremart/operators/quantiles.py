"""Exact quantiles (linear interpolation) without one task holding a column.

``percentile`` keeps every distinct value of a group in one aggregation
buffer. Here values are first counted per distinct value (a hash aggregate
with a map-side step, so a value repeated a billion times is one row) in a
stored table. Groups of up to ``RANKED`` distinct values are ranked by a window
each. For a larger group every wanted rank lies in a bracket of values, at
first all of them; while a bracket holds more than ``RANKED`` distinct values
it is cut at approximate quantiles, the values of each part are counted
exactly, and the part with the rank becomes the bracket. Brackets are a stored
table keyed by group, like the counts: nothing of a group comes to the driver,
so any number of groups can be asked for. Results equal ``percentile`` / DuckDB
``quantile_cont``: for ``n`` values and probability ``p`` the position is
``p * (n - 1)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.session import stored

# Distinct values of a group or bracket that are ranked in one task.
RANKED = 100_000
# Parts that a larger bracket is cut into.
PARTS = 256


def _same(left: DataFrame, right: DataFrame, by: Sequence[str]) -> Column:
    """Null-safe equality of the group columns."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in by])


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str], extra: Sequence[str], cond: Column | None = None) -> DataFrame:
    """``left`` with the columns ``extra`` of ``right``, joined by group."""
    on = _same(left, right, by) if cond is None else _same(left, right, by) & cond
    return left.join(right, on).select(*[left[c] for c in left.columns], *[right[c] for c in extra])


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``*by, _x, _c``: how often each value of a group occurs; stored."""
    vals = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    return stored(vals.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c")), "value-counts")


def _ranked(rows: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``*by, _r, _x``: the values at the ranks ``_ranks`` among rows ranked by key,
    the first of them at rank ``_below``."""
    before = Window.partitionBy(*keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    inside = F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_c")))
    return placed.select(*by, F.explode(inside).alias("_r"), "_x")


def _from_brackets(counts: DataFrame, wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values at the wanted ranks of groups with many distinct values: ``wide`` has
    ``*by, _ranks``."""
    none = F.lit(None).cast("double")
    brackets = wide.select(*by, none.alias("_lo"), none.alias("_hi"), F.lit(0).cast("long").alias("_below"), "_ranks")
    keys = [*by, "_below"]  # brackets of a group start at different ranks
    found = None
    while True:
        inside = (F.col("_lo").isNull() | (F.col("_x") >= F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_x") < F.col("_hi")))
        rows = _joined(counts, brackets, by, ["_lo", "_hi", "_below", "_ranks"], inside)
        cuts = [i / PARTS for i in range(1, PARTS)]
        sizes = stored(
            rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), F.array_distinct(F.percentile_approx("_x", cuts, 20 * PARTS)).alias("_edges")),
            "brackets",
        )
        sized = _joined(rows, sizes, keys, ["_m", "_edges"])
        hits = stored(_ranked(sized.where(F.col("_m") <= RANKED), keys, by), "ranked")
        found = hits if found is None else found.unionByName(hits)
        if sizes.where(F.col("_m") > RANKED).isEmpty():
            return found
        part = F.size(F.filter("_edges", lambda e: e <= F.col("_x")))
        # rows are counted by narrow keys; edges and ranks, two kB a row, come back a part
        parts = sized.where(F.col("_m") > RANKED).groupBy(*keys, part.alias("_part")).agg(F.sum("_c").alias("_n"))
        # at most PARTS rows a bracket
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        counted = parts.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        described = stored(_joined(brackets, sizes, keys, ["_edges"]), "bracket-edges")
        placed = _joined(counted, described, keys, ["_lo", "_hi", "_edges", "_ranks"])
        mine = F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_n")))
        low = F.when(F.col("_part") > 0, F.get("_edges", F.col("_part") - 1)).otherwise(F.col("_lo"))
        high = F.when(F.col("_part") < F.size("_edges"), F.get("_edges", F.col("_part"))).otherwise(F.col("_hi"))
        narrowed = placed.withColumn("_mine", mine).where(F.size("_mine") > 0)
        brackets = stored(
            narrowed.select(*by, low.alias("_lo"), high.alias("_hi"), F.col("_from").alias("_below"), F.col("_mine").alias("_ranks")), "brackets"
        )


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``*by, p, quantile`` from a stored table ``*by, _x, _c`` (distinct values)."""
    by = list(by)
    if not by:  # one group: a key that the planner can't fold, so that joins stay hash joins
        one = counts.withColumn("_one", F.col("_c") * 0)
        return quantiles_of_counts(one, probs, ["_one"]).drop("_one")
    totals = counts.groupBy(*by).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_m")).where(F.col("_n") > 0)
    spots = F.array(*[F.lit(float(p)) for p in probs])
    at = F.transform(spots, lambda p: p * (F.col("_n") - 1))
    ranks = F.array_distinct(F.concat(F.transform(at, lambda x: F.floor(x)), F.transform(at, lambda x: F.ceil(x))))
    totals = stored(totals.withColumn("_ranks", ranks), "quantile-groups")
    narrow = totals.where(F.col("_m") <= RANKED).withColumn("_below", F.lit(0).cast("long"))
    found = _ranked(_joined(counts, narrow, by, ["_ranks", "_below"]), by, by)
    wide = totals.where(F.col("_m") > RANKED)
    if not wide.isEmpty():
        found = found.unionByName(_from_brackets(counts, wide, by))
    # all values of a group that were asked for: at most two a probability
    got = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))
    asked = _joined(totals.select(*by, "_n"), got, by, ["_at"]).select(*by, "_n", "_at", F.explode(spots).alias("p"))
    pos = F.col("p") * (F.col("_n") - 1)
    low, high = (F.element_at("_at", f(pos).cast("long")) for f in (F.floor, F.ceil))
    return asked.select(*by, "p", (low + (pos - F.floor(pos)) * (high - low)).alias("quantile"))


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group (``by``) and probability: ``(*by, p, quantile)``.

    NULL values are ignored; a group without values has no rows.
    """
    return quantiles_of_counts(value_counts(df, value, by), probs, by)


def exact_quantile_value(df: DataFrame, value: str, p: float) -> Column:
    """A literal with one exact quantile of the whole column (NULL without values)."""
    got = exact_quantiles(df, value, [p]).first()
    return F.lit(got["quantile"] if got else None).cast("double")


def approx_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Opt-in approximate form: ``percentile_approx`` keeps a mergeable sketch
    per group (rank error about n / accuracy), so memory does not grow with n."""
    by = list(by)
    q = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy)
    agg = df.where(F.col(value).isNotNull()).groupBy(*by).agg(q.alias("_q"))
    plist = F.array(*[F.lit(float(p)) for p in probs])
    pairs = F.transform("_q", lambda x, i: F.struct(F.element_at(plist, i + 1).alias("p"), x.alias("quantile")))
    return agg.select(*by, F.explode(pairs).alias("_pq")).select(
        *by, F.col("_pq.p").alias("p"), F.col("_pq.quantile").cast("double").alias("quantile")
    )
