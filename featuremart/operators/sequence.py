"""Per-key ordered computations that never put a whole key in one task.

``Window.partitionBy(key)`` sends every row of a key to one task. When one
key may hold a third of all rows that task is the whole job. Here a key is
cut into slices by the calendar period of its first order column (or another
expression that does not decrease along the order). The rows of each slice are
counted once; a slice of more than ``SLICE_ROWS`` rows is cut again at quantiles
of its order columns, whose borders are stored: every branch and every retry
sees the same slices. Each (key, slice) group works alone, and the carry
between slices (the running total or the last row of the slice before) is
computed on a table with one row per (key, slice).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.session import stored

# Calendar period of a slice.
PERIOD = "month"
# Rows of a slice that one task orders; more are cut at quantiles of the order columns.
SLICE_ROWS = 1_000_000
# Parts that a large slice is cut into at once.
CUTS = 128


def _null_free(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for the keys: (coalesced value, is-null flag) columns.

    Windows and the carry join both use these plain columns, so the join's
    required partitioning equals the window's output partitioning and the
    large side is not shuffled again (a null-safe join key would be rewritten
    into new expressions and force that shuffle).
    """
    cols: dict[str, Column] = {}
    names: list[str] = []
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType
        if isinstance(dtype, T.StringType):
            default = F.lit("")
        elif isinstance(dtype, T.BooleanType):
            default = F.lit(False)
        elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            default = F.lit(0).cast("timestamp").cast(dtype)
        else:
            default = F.lit(0).cast(dtype)
        cols[f"_k{i}"] = F.coalesce(F.col(k), default)
        cols[f"_n{i}"] = F.col(k).isNull()
        names += [f"_k{i}", f"_n{i}"]
    return (df.withColumns(cols) if cols else df), names


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | None) -> tuple[DataFrame, list[str], list[str]]:
    """``df`` with key columns, the names of these, and those of the slice."""
    cut = F.date_trunc(PERIOD, F.col(order[0])).cast("timestamp_ntz") if slice_by is None else slice_by
    base, names = _null_free(df.withColumn("_slice", cut), [*keys, "_slice"])
    return base.drop("_slice"), names[:-2], names[-2:]


def _can_be_cut(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


@dataclass(frozen=True)
class Slices:
    """Rows with the columns that name their slice, and a stored table with one
    row per slice: ``_rows`` and the wanted aggregates."""

    rows: DataFrame
    keys: list[str]
    names: list[str]
    totals: DataFrame

    @property
    def group(self) -> list[str]:
        return [*self.keys, *self.names]

    def in_order(self) -> Window:
        """Slices of a key in order; the slice of rows without a time comes first."""
        first, null, *cuts = self.names
        return Window.partitionBy(*self.keys).orderBy(F.col(null).desc(), F.col(first), *cuts)


def _between(low: str, high: str):
    return lambda border: (border > F.col(low)) & (border <= F.col(high))


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | None, aggs: Sequence[Column], most: int | None = None
) -> Slices:
    """``df`` in slices of at most about ``most`` rows (default ``SLICE_ROWS``).

    Large slices are cut at approximate quantiles of the first order column;
    where all their rows share its value, of the next one. Only large slices
    are read again for that, and the rows of all others keep their slice."""
    most = SLICE_ROWS if most is None else most
    rows, kcols, names = _sliced(df, keys, order, slice_by)
    columns = [c for c in order if _can_be_cut(df.schema[c].dataType)]
    ends = [f(F.col(c)).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    spread = [~F.col(f"_lo{i}").eqNullSafe(F.col(f"_hi{i}")) for i in range(len(columns))]
    done = 0
    while True:
        group = [*kcols, *names]
        totals = stored(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"), *ends, *aggs), "slices")
        # the first order column that tells rows of the slice apart
        by = F.coalesce(*[F.when(s, F.lit(i)) for i, s in enumerate(spread)], F.lit(-1)) if columns else F.lit(-1)
        lows = [f"_lo{i}" for i in range(len(columns))]
        large = totals.where(F.col("_rows") > most).withColumn("_by", by).where(F.col("_by") >= 0).select(*group, "_by", *lows)
        if large.isEmpty():
            return Slices(rows, kcols, names, totals)
        inside = rows.select(*group, *columns).join(large, group)
        # quantiles, and the least value above the lowest, so that every round cuts
        quantiles = [
            F.array_append(F.percentile_approx(c, [k / CUTS for k in range(1, CUTS)], 20 * CUTS), F.min(F.when(F.col(c) > F.col(f"_lo{i}"), F.col(c)))).alias(f"_cut{i}")
            for i, c in enumerate(columns)
        ]
        # a border is the first value of its part: the least one opens no part
        borders = stored(inside.groupBy(*group, "_by", *lows).agg(*quantiles), "slice-borders")
        number = F.lit(0)
        for i, c in enumerate(columns):
            below = F.filter(F.array_distinct(f"_cut{i}"), _between(f"_lo{i}", c))
            number = F.when((F.col("_by") == i) & F.col(c).isNotNull(), F.size(below)).otherwise(number)
        name = f"_cut_{done}"
        extra = [c for c in borders.columns if c not in group]
        rows = rows.join(borders, group, "left").withColumn(name, F.coalesce(number, F.lit(0))).drop(*extra)
        names, done = [*names, name], done + 1


def running_sums_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str | Column],
    inclusive: bool = True,
    slice_by: Column | None = None,
) -> DataFrame:
    """Running totals ``sum(value) over (partition by keys order by order)``
    for several values at once (``values`` maps output name → column).

    ``order`` must make rows unique within a key (add an id as tie-break).
    ``slice_by`` must not decrease along it; by default it is the month of the
    first order column. ``inclusive=False`` excludes the current row (0 for a
    key's first row).
    """
    keys, order = list(keys), list(order)
    names = list(values)
    tmp = {f"_v{i}": (F.col(v) if isinstance(v, str) else v) for i, v in enumerate(values.values())}
    s = sliced(df.withColumns(tmp), keys, order, slice_by, [F.sum(t).alias(f"{t}_slice") for t in tmp])
    w = Window.partitionBy(*s.group).orderBy(*order)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = s.rows.withColumns({f"{t}_local": F.coalesce(F.sum(t).over(frame), F.lit(0)) for t in tmp})
    before = s.in_order().rowsBetween(Window.unboundedPreceding, -1)
    carry = s.totals.select(*s.group, *[F.coalesce(F.sum(f"{t}_slice").over(before), F.lit(0)).alias(f"{t}_carry") for t in tmp])
    joined = local.join(carry, s.group, "left")
    outs = [(F.col(f"{t}_local") + F.coalesce(F.col(f"{t}_carry"), F.lit(0))).alias(name) for t, name in zip(tmp, names)]
    return joined.select(*df.columns, *outs)


def running_sum_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    inclusive: bool = True,
    slice_by: Column | None = None,
) -> DataFrame:
    """Single-value form of :func:`running_sums_within`."""
    return running_sums_within(df, keys, order, {out: value}, inclusive, slice_by)


def lag_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    slice_by: Column | None = None,
) -> DataFrame:
    """``lag(value) over (partition by keys order by order)``.

    The first row of a slice takes the last row of the same key in the nearest
    earlier slice that the key has.
    """
    keys, order = list(keys), list(order)
    last_row = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).alias("_val"))
    s = sliced(df, keys, order, slice_by, [F.max(last_row).alias("_tail")])
    w = Window.partitionBy(*s.group).orderBy(*order)
    local = s.rows.withColumns({"_prev": F.lag(value).over(w), "_rn": F.row_number().over(w)})
    carry = s.totals.select(*s.group, F.lag(F.col("_tail").getField("_val")).over(s.in_order()).alias("_carry"))
    joined = local.join(carry, s.group, "left")
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    return joined.select(*df.columns, prev.alias(out))
