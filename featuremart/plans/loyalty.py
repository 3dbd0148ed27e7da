"""Loyalty analysis of ticket orders: currency conversion, outliers, gaps
between orders, user profiles, distributions, segments and associations.

Input ``orders(order_id, user_id, order_time, currency, amount, device,
genre, region, service)``; ``rates(currency, rate_date, rate, nominal)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.quantiles import approx_quantiles, exact_quantile_value
from featuremart.operators.sequence import lag_within
from featuremart.session import stored

BASE_CURRENCY = "RUB"
BROADCAST_RATES = 200_000
PROFILE_ATTRIBUTES: tuple[str, ...] = ("device", "genre", "region", "service")


def convert_currency(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """``revenue_rub = amount * rate / nominal``; base currency unchanged.

    With decimal amounts and rates the result is exact, so later sums do not
    depend on summation order. ``rates`` holds one row per currency and day;
    up to ``BROADCAST_RATES`` rows (counted first) it is broadcast, so the
    orders are not shuffled. A larger one is joined with the orders in other
    currencies alone; those in the base currency need no rate.
    """
    r = rates.select(
        F.col("currency").alias("_cur"), F.col("rate_date").alias("_day"), F.col("rate").alias("_rate"), F.col("nominal").alias("_nominal")
    )
    foreign = F.col("currency") != BASE_CURRENCY
    converted = F.col("amount") * F.col("_rate") / F.col("_nominal")
    revenue = F.when(F.col("currency") == BASE_CURRENCY, F.col("amount")).otherwise(converted)
    same = (F.col("currency") == F.col("_cur")) & (F.to_date("order_time") == F.col("_day"))
    if r.limit(BROADCAST_RATES + 1).count() <= BROADCAST_RATES:
        return orders.join(F.broadcast(r), same, "left").select(*orders.columns, revenue.alias("revenue_rub"))
    other = orders.where(foreign).join(r, same, "left").select(*orders.columns, revenue.alias("revenue_rub"))
    kind = other.schema["revenue_rub"].dataType
    rest = orders.where(F.col("currency").isNull() | ~foreign)
    base = F.when(F.col("currency") == BASE_CURRENCY, F.col("amount")).cast(kind)
    return other.unionByName(rest.select("*", base.alias("revenue_rub")))


def trim_outliers(
    df: DataFrame, column: str = "revenue_rub", p: float = 0.99, cut_lineage: bool = True, exact: bool = True
) -> DataFrame:
    """Drop rows above the exact ``p`` quantile of ``column``.

    The input is read twice (ranking, then filtering); with ``cut_lineage``
    it is stored once below ``spark.checkpoint.dir`` so its upstream plan
    is not recomputed inside the quantile subquery.
    """
    if cut_lineage:
        df = stored(df, "untrimmed")
    if exact:
        limit = exact_quantile_value(df, column, p)
    else:
        limit = approx_quantiles(df, column, [p]).select("quantile").scalar()
    return df.where(F.col(column).cast("double") <= limit)


def order_gaps(orders: DataFrame) -> DataFrame:
    """Previous order time of the same user and the gap in days."""
    gaps = lag_within(orders, ["user_id"], ["order_time", "order_id"], "order_time", "prev_order_time")
    return gaps.withColumn("gap_days", F.datediff(F.col("order_time"), F.col("prev_order_time")))


def user_profile(gaps: DataFrame, attributes: Sequence[str] = PROFILE_ATTRIBUTES) -> DataFrame:
    """One aggregate per user over the order table with gaps.

    First- and last-order attributes come from ``min`` and ``max`` of
    ``struct(order_time, order_id, ...)`` (ties by id).
    """
    last = F.max(F.struct("order_time", "order_id", "revenue_rub", *attributes)).alias("_last")
    weekend = F.dayofweek("order_time").isin(1, 7)
    first = F.min(F.struct("order_time", "order_id", *attributes)).alias("_first")
    agg = gaps.groupBy("user_id").agg(
        first,
        last,
        F.max("order_time").alias("last_order"),
        F.min("revenue_rub").alias("min_revenue_rub"),
        F.max("revenue_rub").alias("max_revenue_rub"),
        F.size(F.collect_set("region")).cast("long").alias("n_regions"),
        F.size(F.collect_set("service")).cast("long").alias("n_services"),
        F.size(F.collect_set(F.month("order_time"))).cast("long").alias("n_months"),
        (F.count_if(weekend) / F.count(F.lit(1))).alias("weekend_share"),
        F.max("gap_days").alias("max_gap_days"),
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("revenue_rub").alias("revenue_rub"),
        (F.sum("revenue_rub").cast("double") / F.count(F.lit(1))).alias("avg_revenue_rub"),
        # categories per user: sets bounded by the category domain, merged
        # map-side; avoids the Expand of two distinct aggregates
        F.size(F.collect_set("genre")).cast("long").alias("n_genres"),
        F.size(F.collect_set("device")).cast("long").alias("n_devices"),
        F.avg("gap_days").alias("avg_gap_days"),
    )
    return agg.select(
        "user_id",
        F.col("_first.order_time").alias("first_order"),
        "last_order",
        "n_orders",
        "revenue_rub",
        "avg_revenue_rub",
        *[F.col(f"_first.{a}").alias(f"first_{a}") for a in attributes],
        *[F.col(f"_last.{a}").alias(f"last_{a}") for a in attributes],
        F.col("_last.revenue_rub").alias("last_revenue_rub"),
        "min_revenue_rub",
        "max_revenue_rub",
        F.datediff("last_order", "_first.order_time").cast("long").alias("span_days"),
        "n_regions",
        "n_services",
        "n_months",
        "weekend_share",
        F.col("max_gap_days").cast("long").alias("max_gap_days"),
        "n_genres",
        "n_devices",
        "avg_gap_days",
        (F.col("n_orders") >= 2).alias("is_two"),
        (F.col("n_orders") >= 5).alias("is_five"),
    )


def histogram(df: DataFrame, column: str, lo: float, hi: float, buckets: int) -> DataFrame:
    """Equal-width histogram rows: bucket 0 below ``lo``, ``buckets + 1`` at or above ``hi``."""
    b = F.width_bucket(F.col(column).cast("double"), F.lit(lo), F.lit(hi), F.lit(buckets))
    width = (hi - lo) / buckets
    counted = df.where(F.col(column).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(
        "bucket",
        (F.lit(lo) + (F.col("bucket") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bucket") * F.lit(width)).alias("upper"),
        "rows",
    )


def first_order_segments(profile: DataFrame, attributes: Sequence[str] = ("genre", "device")) -> DataFrame:
    """Per first-order attribute value: users, share of all users, return share.

    One pass over the profile: each user contributes one row per attribute,
    grouped by (attribute, value). The total per attribute (= all users)
    comes from a window over that small grouped table, so the profile is
    computed once.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"first_{a}").alias("value")) for a in attributes])
    )
    long = profile.select(pairs.alias("s"), F.col("is_two").cast("double").alias("_two")).select("s.*", "_two")
    grouped = long.groupBy("attribute", "value").agg(
        F.count(F.lit(1)).alias("users"), F.avg("_two").alias("return_share")
    )
    total = F.sum("users").over(Window.partitionBy("attribute"))
    return grouped.withColumn("share", F.col("users") / total)


def loyalty_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count(F.lit(1)).alias("users"),
        F.avg((F.col("n_orders") == 1).cast("double")).alias("one_time_share"),
        F.avg(F.when(F.col("n_orders") >= 5, F.col("avg_gap_days"))).alias("avg_gap_days_5plus"),
    )


def association(
    profile: DataFrame,
    categorical: Sequence[str] = tuple(f"first_{a}" for a in PROFILE_ATTRIBUTES),
    numeric: Sequence[str] = ("n_orders", "revenue_rub", "avg_gap_days"),
) -> DataFrame:
    """χ² and Cramér's V for each pair of categorical columns, Pearson r for
    each pair of numeric columns: ``(col_a, col_b, measure, value)``.

    Contingency counts are computed in Spark (one shuffle of a few rows per
    user); χ² uses only non-empty cells: ``n * (Σ o² / (row * col) - 1)``.
    """
    pairs = [(a, b) for i, a in enumerate(categorical) for b in categorical[i + 1 :]]
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(a).alias("a"), F.col(b).alias("b"))
                for a, b in pairs
            ]
        )
    )
    long = profile.select(cells.alias("c")).select("c.*")
    table = long.groupBy("col_a", "col_b", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    # a row of the contingency table has as many cells as the other attribute has values
    table = table.withColumns(
        {
            "ra": F.sum("o").over(Window.partitionBy("col_a", "col_b", "a")),
            "cb": F.sum("o").over(Window.partitionBy("col_a", "col_b", "b")),
            # shares that add up to the number of values, without an Expand
            "ua": F.when(F.col("a").isNotNull(), 1 / F.count(F.lit(1)).over(Window.partitionBy("col_a", "col_b", "a"))),
            "ub": F.when(F.col("b").isNotNull(), 1 / F.count(F.lit(1)).over(Window.partitionBy("col_a", "col_b", "b"))),
        }
    )
    per_pair = table.groupBy("col_a", "col_b").agg(
        (F.sum("o") * (F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))) - 1)).alias("chi2"),
        F.sum("o").alias("n"),
        F.round(F.sum("ua")).cast("long").alias("r"),
        F.round(F.sum("ub")).cast("long").alias("k"),
    )
    v = F.sqrt(F.greatest(F.col("chi2"), F.lit(0.0)) / (F.col("n") * (F.least("r", "k") - 1)))
    cat = per_pair.select(
        "col_a",
        "col_b",
        F.explode(
            F.array(
                F.struct(F.lit("chi2").alias("measure"), F.col("chi2").alias("value")),
                F.struct(F.lit("cramers_v").alias("measure"), v.alias("value")),
            )
        ).alias("m"),
    ).select("col_a", "col_b", "m.measure", "m.value")
    num_pairs = [(a, b) for i, a in enumerate(numeric) for b in numeric[i + 1 :]]
    if not num_pairs:
        return cat
    num = profile.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in num_pairs])
    num_long = num.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.lit("pearson").alias("measure"),
                             F.col(f"`{a}|{b}`").alias("value"))
                    for a, b in num_pairs
                ]
            )
        ).alias("m")
    ).select("m.*")
    return cat.unionByName(num_long)
