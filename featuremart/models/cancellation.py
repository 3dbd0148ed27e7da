"""Booking-cancellation model: review TF-IDF + stay and history features,
tree ensembles, Platt calibration and feature importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer, StopWordsRemover, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.models.fitting import fitted

SEED = 42
# Hashed words of the reviews; large, so that words seldom share a place.
TEXT_FEATURES = 1 << 18
# Words kept for the trees: those that tell cancelled bookings best.
TEXT_KEPT = 200
# The first of the text stages learn nothing: they turn a text into hashed words.
WORD_STAGES = 3


def text_stages(text_col: str = "review", text_features: int = TEXT_FEATURES, kept: int = TEXT_KEPT) -> list:
    """Which words a review has, reduced by a chi-squared test against ``label``
    before the trees, then TF-IDF."""
    select = UnivariateFeatureSelector(featuresCol="_tf", labelCol="label", outputCol="_best", selectionMode="numTopFeatures")
    select.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(kept)
    return [
        RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[^\p{L}]+", toLowercase=True),
        StopWordsRemover(inputCol="_tokens", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=text_features, binary=True),
        select,
        IDF(inputCol="_best", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="review_tfidf", p=2.0),
    ]


def tree_stages(numeric: Sequence[str], model: str = "rf", vectors: Sequence[str] = ("review_tfidf",)) -> list:
    """Numeric columns and vectors in one vector, and the trees."""
    assemble = VectorAssembler(inputCols=[*numeric, *vectors], outputCol="features", handleInvalid="keep")
    if model == "rf":
        est = RandomForestClassifier(labelCol="label", numTrees=30, maxDepth=6, seed=SEED)
    elif model == "gbt":
        est = GBTClassifier(labelCol="label", maxIter=20, maxDepth=4, seed=SEED)
    else:
        raise ValueError(model)
    return [assemble, est]


def cancel_pipeline(numeric: Sequence[str], model: str = "rf") -> Pipeline:
    return Pipeline(stages=text_stages() + tree_stages(numeric, model))


def positive_score(scored: DataFrame) -> DataFrame:
    return scored.withColumn("score", vector_to_array("probability")[1])


def platt_calibrate(held_out: DataFrame, apply_to: DataFrame | None = None) -> tuple[DataFrame, object]:
    """Fit ``P(y=1 | s) = 1 / (1 + exp(A·s + B))`` on held-out scores, and add
    ``calibrated`` to ``apply_to`` (other rows, to judge it on; default: the same).

    Smoothed targets (Platt 1999): positives t+ = (N+ + 1)/(N+ + 2),
    negatives t− = 1/(N− + 2). Each row is emitted twice, labelled 1 with
    weight t and 0 with weight 1 − t, so a weighted logistic regression
    minimises the cross-entropy against the smoothed target.
    """
    counts = held_out.agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")).first()
    pos, neg = float(counts["pos"] or 0), float(counts["n"] - (counts["pos"] or 0))
    t_pos, t_neg = (pos + 1) / (pos + 2), 1 / (neg + 2)
    t = F.when(F.col("label") == 1, F.lit(t_pos)).otherwise(F.lit(t_neg))
    s = VectorAssembler(inputCols=["score"], outputCol="s_vec").transform(held_out.withColumn("_t", t))
    twice = s.select(
        "s_vec", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("_t").alias("w")),
                                   F.struct(F.lit(0.0).alias("y"), (1 - F.col("_t")).alias("w")))).alias("r")
    ).select("s_vec", F.col("r.y").alias("y"), F.col("r.w").alias("w"))
    lr = LogisticRegression(
        featuresCol="s_vec", labelCol="y", weightCol="w", regParam=0.0, maxIter=100,
        predictionCol="platt_prediction", probabilityCol="platt_probability", rawPredictionCol="platt_raw",
    )
    lr = fitted(Pipeline(stages=[lr]), twice).stages[-1]
    if apply_to is not None:
        s = VectorAssembler(inputCols=["score"], outputCol="s_vec").transform(apply_to)
    return lr.transform(s).withColumn("calibrated", vector_to_array("platt_probability")[1]), lr


def feature_importance(model: PipelineModel, scored: DataFrame) -> list[tuple[str, float]]:
    """Tree-ensemble importances zipped with the assembler's feature names."""
    attrs = scored.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(((names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)), key=lambda x: (-x[1], x[0]))
