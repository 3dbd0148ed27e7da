"""Weekly sales forecaster: boosted trees with early stopping, inference over
the plan weeks one after another, clipping and a batched write to the result
store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.models.fitting import spread
from featuremart.plans.forecast import SERIES, calendar_features, lag_features, week_index
from featuremart.session import stored

SEED = 42
LAGS = (1, 2, 3, 4)
HORIZON = 4
# Training rows that one task of the fit holds, cached by the trees.
ROWS_PER_TASK = 500_000
FEATURES: tuple[str, ...] = (
    *[f"lag_{k}" for k in LAGS], *[f"has_lag_{k}" for k in LAGS], "rolling_mean_4", "week_of_year", "month",
    "store_lines", "avg_discount",
)


def _filled() -> dict[str, Column]:
    """Numbers for the trees: a flag tells a missing week from one without sales."""
    flags = {f"has_lag_{k}": F.col(f"lag_{k}").isNotNull().cast("double") for k in LAGS}
    gaps = [*[f"lag_{k}" for k in LAGS], "rolling_mean_4", "store_lines", "avg_discount"]
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in gaps}
    return flags | numbers | {c: F.col(c).cast("double") for c in ("week_of_year", "month")}


def known_ahead(store_features: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Store features moved ``horizon`` weeks on, so that a plan week only uses
    what is known when the plan is made."""
    return store_features.withColumn("week", F.timestamp_add("DAY", F.lit(7 * horizon), F.col("week")))


def training_frame(history: DataFrame, store_features: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """History rows with features and ``label``; missing lags are 0 with a flag of 0."""
    lagged = calendar_features(lag_features(history.withColumn("is_plan", F.lit(False))))
    frame = lagged.join(known_ahead(store_features, horizon), ["store_id", "week"], "left")
    return frame.withColumns(_filled()).withColumn("label", F.col("sales").cast("double")).select(*SERIES, "week", "label", *FEATURES)


def forecaster(features: Sequence[str] = FEATURES, max_iter: int = 40) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            GBTRegressor(
                labelCol="label", maxIter=max_iter, maxDepth=5, stepSize=0.1, seed=SEED,
                validationIndicatorCol="is_validation", validationTol=0.001,
            ),
        ]
    )


def series_state(history: DataFrame, last_week: Column) -> DataFrame:
    """One row per series with its sales in the last weeks (``lag_1`` is the last
    week of the whole history; NULL where the series sold nothing)."""
    back = week_index(last_week) - week_index()
    return history.groupBy(*SERIES).agg(
        *[F.sum(F.when(back == k - 1, F.col("sales"))).cast("double").alias(f"lag_{k}") for k in LAGS]
    )


def predict_horizon(
    model, state: DataFrame, store_features: DataFrame, last_week: Column, horizon: int = HORIZON
) -> DataFrame:
    """Forecasts of ``horizon`` weeks, clipped at zero. Each week's forecast is the
    next week's ``lag_1``: the loop only adds columns to one row per series."""
    ahead = known_ahead(store_features, horizon)
    now = state.select(*SERIES, *[F.col(f"lag_{k}").alias(f"s{k}") for k in LAGS], F.array().cast("array<double>").alias("out"))
    for step in range(1, horizon + 1):
        week = F.timestamp_add("DAY", F.lit(7 * step), last_week)
        known = F.filter(F.array(*[F.col(f"s{k}") for k in LAGS]), lambda x: x.isNotNull())
        mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))
        frame = now.withColumn("week", week).withColumns({f"lag_{k}": F.col(f"s{k}") for k in LAGS} | {"rolling_mean_4": mean})
        frame = calendar_features(frame).join(ahead, ["store_id", "week"], "left").withColumns(_filled())
        forecast = F.greatest(F.col("prediction"), F.lit(0.0))
        moved = [F.col(f"s{k - 1}").alias(f"s{k}") for k in LAGS[1:]]
        now = model.transform(frame).select(*SERIES, forecast.alias("s1"), *moved, F.concat("out", F.array(forecast)).alias("out"))
    weeks = now.select(*SERIES, F.posexplode("out").alias("_k", "forecast"))
    return weeks.select(*SERIES, F.timestamp_add("DAY", 7 * (F.col("_k") + 1), last_week).alias("week"), "forecast")


def write_results(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    batch_size: int = 10000,
) -> None:
    """Write forecasts: ``fmt="jdbc"`` with ``url``/``dbtable`` in ``options``
    inserts in batches of ``batch_size`` from every partition in parallel;
    any file format overwrites ``target``."""
    writer = df.write.mode("overwrite")
    if fmt == "jdbc":
        writer.format("jdbc").options(**dict(options or {})).option("batchsize", batch_size).save()
    else:
        writer.format(fmt).options(**dict(options or {})).save(target)


def forecast_run(history: DataFrame, store_features: DataFrame, model_path: str, out: str,
                 validation_from: str, horizon: int = HORIZON) -> DataFrame:
    """End to end: history → lag / rolling / calendar features → fit with early
    stopping on the last weeks → save → load → forecast the plan weeks one
    after another → clip → write. History and store features are computed
    once and stored. Returns the written forecasts (read back)."""
    history = stored(history.select(*SERIES, "week", "sales"), "sales")
    store_features = stored(store_features, "store-features")
    data = stored(training_frame(history, store_features, horizon), "sales-frame")
    data = spread(data, ROWS_PER_TASK).withColumn("is_validation", F.col("week") >= F.lit(validation_from).cast("timestamp_ntz"))
    model = forecaster().fit(data)
    model.write().overwrite().save(model_path)
    loaded = PipelineModel.load(model_path)
    last_week = F.lit(history.agg(F.max("week")).first()[0]).cast("timestamp_ntz")
    preds = predict_horizon(loaded, series_state(history, last_week), store_features, last_week, horizon)
    write_results(preds, out)
    return preds.sparkSession.read.parquet(out)
