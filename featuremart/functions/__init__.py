"""Column expressions: built-in Spark functions only, so they stay in codegen."""

from featuremart.functions.columns import (
    days_between,
    in_window,
    lenient_double,
    safe_ratio,
    seconds_between,
    window_start,
)

__all__ = [
    "days_between",
    "in_window",
    "lenient_double",
    "safe_ratio",
    "seconds_between",
    "window_start",
]
