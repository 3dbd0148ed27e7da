"""Scalar column helpers shared by the feature operators.

Each returns a ``Column`` built from ``pyspark.sql.functions``; nothing here
runs Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp literal (``timestamp_ntz``)."""
    return F.lit(value).cast(T.TimestampNTZType())


def window_start(run_date: dt.datetime, days: int) -> dt.datetime:
    """Lower bound of a ``days`` window ending at ``run_date``."""
    return run_date - dt.timedelta(days=days)


def in_window(ts: ColumnOrName, run_date: dt.datetime, days: int) -> Column:
    """Half-open window ``[run_date - days, run_date)`` on a timestamp column."""
    c = _col(ts)
    return (c >= ts_literal(window_start(run_date, days))) & (c < ts_literal(run_date))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional seconds from ``start`` to ``end`` (microsecond exact)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1_000_000.0)


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole elapsed 24-hour periods from ``start`` to ``end``.

    An event at 23:00 the evening before gives 0, unlike ``datediff``.
    """
    return F.timestamp_diff("DAY", _col(start), _col(end))


# Java's number parser accepts a trailing type suffix ("1.5d", "2f") that a
# lenient decimal parser rejects; such text is treated as malformed.
_TYPE_SUFFIX = r"[dDfF]\s*$"


def lenient_double(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Parse money leniently: malformed text, NULL and NaN all become 0.0.

    Numeric inputs are only widened. Text goes through ``try_cast`` (never
    raises under ANSI mode); text that parses to NaN is folded to 0 as well.
    """
    c = _col(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        parsed = c.cast("double")
    else:
        text = F.trim(c.cast("string"))
        parsed = F.when(text.rlike(_TYPE_SUFFIX), F.lit(None).cast("double")).otherwise(
            text.try_cast("double")
        )
    return F.coalesce(F.nanvl(parsed, F.lit(None).cast("double")), F.lit(0.0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, zero_fill: bool = False) -> Column:
    """Ratio of two event counts.

    Defined only when both counts are at least 1; otherwise NULL (or 0.0
    with ``zero_fill``). Counts are the pre-fill values, so a customer with no
    events of either kind gets NULL.
    """
    n, d = _col(num), _col(den)
    ok = (n > 0) & (d > 0)
    ratio = n.cast("double") / d.cast("double")
    if zero_fill:
        return F.when(ok, ratio).otherwise(F.lit(0.0))
    return F.when(ok, ratio)
