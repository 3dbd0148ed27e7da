"""Per-user behaviour features for the age-group model and its evaluation.

``visits(user_id, ts, category, value)``: one row per visit; categories are
a fixed list so the pivot compiles to conditional counts in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def visit_features(visits: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One aggregate per user: visit statistics and the share of each category.

    The fixed category list turns the pivot into conditional counts inside
    the same aggregate as the total, so visits are shuffled once and no join
    is needed for the denominator.
    """
    per_cat = [F.count_if(F.col("category") == c).alias(f"_n_{i}") for i, c in enumerate(categories)]
    agg = visits.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.avg("value").alias("avg_value"),
        F.stddev_samp("value").alias("std_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count_distinct("category").alias("n_categories"),
        F.min("ts").alias("first_visit"),
        F.max("ts").alias("last_visit"),
        *per_cat,
    )
    shares = {f"share_{c}": F.col(f"_n_{i}") / F.col("visits") for i, c in enumerate(categories)}
    return agg.withColumns(shares).drop(*[f"_n_{i}" for i in range(len(categories))])


def category_shares(visits: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Share of each user's visits per category (``share_<category>``)."""
    return visit_features(visits, categories).select("user_id", *[f"share_{c}" for c in categories])


def usage_stats(visits: DataFrame) -> DataFrame:
    return visits.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.avg("value").alias("avg_value"),
        F.stddev_samp("value").alias("std_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count_distinct("category").alias("n_categories"),
        F.min("ts").alias("first_visit"),
        F.max("ts").alias("last_visit"),
    )


def user_wide(
    users: DataFrame,
    visits: DataFrame,
    orders: DataFrame,
    order_lines: DataFrame,
    categories: Sequence[str],
    device: DataFrame | None = None,
    ads: DataFrame | None = None,
    cloud: DataFrame | None = None,
) -> DataFrame:
    """Users left-joined to per-user aggregates of every other table.

    Each table is reduced to one row per user (lines first to one row per
    order) before joining, so nothing fans out. Optional tables:
    ``device(user_id, device, seconds)``, ``ads(user_id, site, size)``,
    ``cloud(user_id, operation, bytes)``; a user without rows there has zeros.
    """
    per_order = order_lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("quantity").alias("_qty")
    )
    per_user_orders = orders.join(per_order, "order_id", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("amount").alias("order_amount"),
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("n_lines"),
        F.sum("_qty").alias("quantity"),
    )
    wide = users.join(visit_features(visits, categories), "user_id", "left").join(
        per_user_orders, "user_id", "left"
    )
    extra = {
        "device": (device, ("device_sessions", "device_seconds", "n_devices"), ("seconds", "device")),
        "ads": (ads, ("ad_views", "ad_size", "n_ad_sites"), ("size", "site")),
        "cloud": (cloud, ("cloud_operations", "cloud_bytes", "n_cloud_kinds"), ("bytes", "operation")),
    }
    for table, (n_rows, total, kinds), (amount, kind) in extra.values():
        if table is None:
            continue
        # rows per kind first: no Expand, and a hot user shrinks before the shuffle
        per_kind = table.groupBy("user_id", kind).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum"))
        per_user = per_kind.groupBy("user_id").agg(
            F.sum("_n").alias(n_rows), F.sum("_sum").alias(total), F.count(kind).alias(kinds)
        )
        wide = wide.join(per_user, "user_id", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in (n_rows, total, kinds)})
    return wide.withColumns(
        {
            "visits": F.coalesce("visits", F.lit(0)),
            "n_categories": F.coalesce("n_categories", F.lit(0)),
            "n_orders": F.coalesce("n_orders", F.lit(0)),
            "n_lines": F.coalesce("n_lines", F.lit(0)),
        }
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class from (label, prediction) counts."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    per_class = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("c"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                         F.lit(0).cast("long").alias("fp"), F.when(F.col("y") != F.col("p"), F.col("n")).otherwise(0).alias("fn"),
                         F.col("n").alias("support")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("tp"),
                         F.when(F.col("y") != F.col("p"), F.col("n")).otherwise(0).alias("fp"), F.lit(0).cast("long").alias("fn"),
                         F.lit(0).cast("long").alias("support")),
            )
        ).alias("s")
    ).groupBy(F.col("s.c").alias("class")).agg(
        F.sum("s.tp").alias("tp"), F.sum("s.fp").alias("fp"), F.sum("s.fn").alias("fn"), F.sum("s.support").alias("support")
    )
    precision = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    recall = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return per_class.select("class", precision.alias("precision"), recall.alias("recall"), "support").withColumn(
        "f1",
        F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0),
    )


def macro_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Unweighted mean of per-class F1 (MLlib's ``f1`` metric is weighted)."""
    return class_report(df, label, prediction).agg(
        F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("classes"), F.sum("support").alias("n")
    )
