"""Conversion ratios between event counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from featuremart.functions.columns import safe_ratio

from featuremart.operators.constants import DEFAULT_WINDOWS  # noqa: E402


def conversion_columns(windows: Sequence[int] = DEFAULT_WINDOWS) -> list[str]:
    return [f"conversion_page_to_cart_{n}" for n in windows] + [
        f"conversion_cart_to_purchase_{n}" for n in windows
    ]


def add_conversions(
    features: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill: bool = False
) -> DataFrame:
    """Add page→cart and cart→purchase ratios per window.

    Must run on the counts before their zero fill: a missing count means the
    ratio is undefined (NULL), not 0.
    """
    cols = {}
    for n in windows:
        cols[f"conversion_page_to_cart_{n}"] = safe_ratio(f"add_to_cart_{n}", f"page_view_{n}", zero_fill)
    for n in windows:
        cols[f"conversion_cart_to_purchase_{n}"] = safe_ratio(f"purchase_{n}", f"add_to_cart_{n}", zero_fill)
    return features.withColumns(cols)
