"""Weekly sales forecasting: panel assembly, plan rows, lag / rolling /
calendar features, feature drift (PSI), clipping and regression metrics.

Inputs: ``sales(store_id, dept, week, sales)`` at one row per store,
department and week (money as a decimal), ``stores(store_id, ...)``,
``store_features(store_id, week, ...)``.

Lag and rolling features use RANGE frames over an integer week index, so a
missing week yields NULL instead of silently shifting to an older row. The
window groups are ``(store_id, dept)`` series whose length is bounded by the
number of weeks in the calendar, not by the data volume.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.quantiles import approx_quantiles, quantiles_of_counts
from featuremart.session import stored

SERIES = ("store_id", "dept")
EPOCH_MONDAY = dt.date(1970, 1, 5)
# Public holidays as month-day, used for the holiday-week flag.
HOLIDAYS: tuple[str, ...] = ("01-01", "01-07", "02-23", "03-08", "05-01", "05-09", "06-12", "11-04")
PSI_FLOOR = 1e-6


def week_index(week: str | Column = "week") -> Column:
    w = F.col(week) if isinstance(week, str) else week
    return F.floor(F.datediff(F.to_date(w), F.lit(EPOCH_MONDAY)) / 7).cast("long")


def sales_panel(sales: DataFrame, stores: DataFrame, store_features: DataFrame) -> DataFrame:
    """Sales with store attributes (a dimension) and per-(store, week) features."""
    return sales.join(stores, "store_id", "left").join(store_features, ["store_id", "week"], "left")


def with_plan(history: DataFrame, horizon: int = 4) -> DataFrame:
    """History rows plus ``horizon`` plan weeks per series after the last history week.

    Plan rows carry NULL sales and ``is_plan = true``; every series seen in
    the history gets the same plan weeks (explode, no cross join).
    """
    last_week = history.select(F.max("week")).scalar()
    series = history.select(*SERIES).distinct()
    plan = series.select(
        *SERIES,
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_k"),
    ).select(
        *SERIES,
        F.timestamp_add("DAY", F.col("_k") * 7, last_week).alias("week"),
        F.lit(None).cast(history.schema["sales"].dataType).alias("sales"),
        F.lit(True).alias("is_plan"),
    )
    hist = history.select(*SERIES, "week", "sales", F.lit(False).alias("is_plan"))
    return hist.unionByName(plan)


def _series_window(lo: int, hi: int) -> Window:
    return Window.partitionBy(*SERIES).orderBy("_widx").rangeBetween(lo, hi)


def lag_features(frame: DataFrame, lags: Sequence[int] = (1, 2, 3, 4), roll: int = 4) -> DataFrame:
    """``lag_k`` = sales exactly k weeks earlier; ``rolling_mean_<roll>`` over
    the previous ``roll`` weeks (current week excluded)."""
    f = frame.withColumn("_widx", week_index())
    cols = {f"lag_{k}": F.sum("sales").over(_series_window(-k, -k)).cast("double") for k in lags}
    w = _series_window(-roll, -1)
    cols[f"rolling_mean_{roll}"] = F.sum("sales").over(w).cast("double") / F.nullif(
        F.count("sales").over(w), F.lit(0)
    )
    return f.withColumns(cols).drop("_widx")


def calendar_features(frame: DataFrame, week: str = "week") -> DataFrame:
    """Week of year, month, quarter, year and a holiday-week flag."""
    days = F.sequence(F.to_date(week), F.date_add(F.to_date(week), 6))
    holiday = F.exists(days, lambda d: F.date_format(d, "MM-dd").isin(*HOLIDAYS))
    return frame.withColumns(
        {
            "week_of_year": F.weekofyear(week),
            "month": F.month(week),
            "quarter": F.quarter(week),
            "year": F.year(week),
            "is_holiday_week": holiday,
        }
    )


def naive_forecast(frame: DataFrame) -> DataFrame:
    """Linear extrapolation from the last two weeks, clipped at zero."""
    raw = F.lit(2.0) * F.col("lag_1") - F.col("lag_2")
    return frame.withColumns({"raw_forecast": raw, "forecast": F.greatest(raw, F.lit(0.0))})


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """R² = 1 − SSE/SST and MAE over rows with both values."""
    d = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).select(
        F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")
    )
    sse = F.sum((F.col("y") - F.col("p")) ** 2)
    sst = F.var_pop("y") * F.count(F.lit(1))  # stable, unlike Σy² − (Σy)²/n
    return d.agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(1.0) - sse / sst).alias("r2"),
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
    )


def psi(
    frame: DataFrame,
    features: Sequence[str],
    is_current: Column,
    bins: int = 10,
    floor: float = PSI_FLOOR,
    cut_lineage: bool = True,
    exact: bool = True,
) -> DataFrame:
    """Population stability index per feature: baseline = rows where
    ``is_current`` is false, decile edges from its exact quantiles.

    Rows are reduced once to counts per (feature, part, value); with
    ``cut_lineage`` these are stored. Quantiles and buckets both come from the
    counts, the rows are not read again.
    """
    long = frame.select(
        is_current.alias("_cur"),
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
        ).alias("_f"),
    ).select("_cur", "_f.feature", "_f.x").where(F.col("x").isNotNull())
    values = long.groupBy("feature", "_cur", F.col("x").alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    if cut_lineage:
        values = stored(values, "psi-values")
    probs = [i / bins for i in range(1, bins)]
    base = values.where(~F.col("_cur"))
    quantiles = (
        quantiles_of_counts(base.select("feature", "_x", "_c"), probs, by=["feature"])
        if exact
        else approx_quantiles(long.where(~F.col("_cur")), "x", probs, by=["feature"])
    )
    edges = (
        quantiles.groupBy("feature")
        .agg(F.array_sort(F.collect_list(F.struct("p", "quantile"))).alias("_e"))
        .select("feature", F.transform("_e", lambda s: s["quantile"]).alias("edges"))
    )
    # one row per feature: broadcast size bounded by the feature list
    bucketed = values.join(F.broadcast(edges), "feature").withColumn(
        "bucket", F.size(F.filter("edges", lambda e: F.col("_x") > e))
    )
    counts = bucketed.groupBy("feature", "_cur", "bucket").agg(F.sum("_c").alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("feature", "_cur")))
    base = shares.where(~F.col("_cur")).select("feature", "bucket", F.col("share").alias("e"))
    cur = shares.where(F.col("_cur")).select("feature", "bucket", F.col("share").alias("a"))
    both = base.join(cur, ["feature", "bucket"], "full_outer")
    e = F.greatest(F.coalesce("e", F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce("a", F.lit(0.0)), F.lit(floor))
    return both.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
