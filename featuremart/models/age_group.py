"""Multiclass age-group model over the wide per-user table.

Pipeline: Imputer → StringIndexer(handleInvalid="keep") → OneHotEncoder →
VectorAssembler → StandardScaler → classifier. Feature selection by a
univariate test (K best) and by recursive elimination (drop the feature with
the smallest largest-absolute coefficient, refit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.models.kernel import RandomFourierFeatures
from featuremart.plans.usage import macro_f1
from featuremart.session import stored

SEED = 42


def prepare(df: DataFrame, numeric: Sequence[str], label: str) -> DataFrame:
    cols = {c: F.col(c).cast("double") for c in numeric}
    return df.withColumns(cols)


def preprocessing(numeric: Sequence[str], categorical: Sequence[str], label: str) -> list:
    """Stages that turn raw columns into a scaled ``features`` vector and ``label``."""
    imputed = [f"{c}_imp" for c in numeric]
    stages: list = [Imputer(inputCols=list(numeric), outputCols=imputed, strategy="median")]
    idx = [f"{c}_idx" for c in categorical]
    stages += [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep")]
    ohe = [f"{c}_ohe" for c in categorical]
    stages += [OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep")]
    stages += [VectorAssembler(inputCols=imputed + ohe, outputCol="raw_features", handleInvalid="keep")]
    stages += [StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]
    stages += [StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip")]
    return stages


def classifier_pipeline(
    numeric: Sequence[str], categorical: Sequence[str], label: str, model: str = "logreg"
) -> Pipeline:
    if model == "logreg":
        est = LogisticRegression(family="multinomial", maxIter=50, regParam=0.01)
    elif model == "linear_svc":
        est = OneVsRest(classifier=LinearSVC(maxIter=50, regParam=0.01), parallelism=4)
    elif model == "rbf_svc":
        return Pipeline(stages=preprocessing(numeric, categorical, label) + rbf_stages())
    else:
        raise ValueError(model)
    return Pipeline(stages=preprocessing(numeric, categorical, label) + [est])


def rbf_stages(dimensions: int = 256, gamma: float = 0.0, reg: float = 1e-4) -> list:
    """A machine with the radial kernel: random Fourier features of the scaled
    vector, then linear machines, one a class."""
    machine = LinearSVC(featuresCol="fourier", maxIter=25, regParam=reg)
    return [
        RandomFourierFeatures(inputCol="features", outputCol="fourier", dimensions=dimensions, gamma=gamma, seed=SEED),
        OneVsRest(featuresCol="fourier", classifier=machine, parallelism=4),
    ]


def anova_f(df: DataFrame, numeric: Sequence[str], label: str) -> DataFrame:
    """``feature, f_value``: the one-way ANOVA F statistic of each numeric column
    over the classes of ``label`` (rows where either is NULL left out). Means
    and squared deviations per class come from one aggregate over the rows."""
    long = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_class"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in numeric])).alias("_f"),
    ).select("_class", "_f.*").where(F.col("x").isNotNull())
    per = long.groupBy("feature", "_class").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), (F.var_pop("x") * F.count(F.lit(1))).alias("ss")
    )
    whole = per.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ss").alias("within"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.pow(F.sum(F.col("n") * F.col("m")), F.lit(2)) / F.sum("n")).alias("between"),
    )
    f = (F.col("between") / (F.col("k") - 1)) / F.nullif(F.col("within") / (F.col("n") - F.col("k")), F.lit(0.0))
    return whole.select("feature", f.alias("f_value"))


def select_k_best(df: DataFrame, numeric: Sequence[str], label: str, k: int) -> list[tuple[str, float]]:
    """The ``k`` numeric features with the largest ANOVA F, best first (ties by name)."""
    top = anova_f(df, numeric, label).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k)
    return [(r["feature"], r["f_value"]) for r in top.collect()]


def recursive_elimination(df: DataFrame, numeric: Sequence[str], label: str, target: int) -> list[tuple[int, str, int]]:
    """Drop one feature per step until ``target`` remain: (step, dropped, remaining).

    The rows are stored once; every step fits on that narrow table."""
    df = stored(df.select(label, *numeric), "rfe")
    keep = list(numeric)
    steps = []
    step = 0
    while len(keep) > target:
        model = classifier_pipeline(keep, [], label).fit(df)
        coef = model.stages[-1].coefficientMatrix.toArray()
        weakest = min(range(len(keep)), key=lambda j: (max(abs(coef[i][j]) for i in range(coef.shape[0])), keep[j]))
        step += 1
        dropped = keep.pop(weakest)
        steps.append((step, dropped, len(keep)))
    return steps


def grid_search(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, folds: int = 3):
    """Cross-validated grid over regularisation by macro F1 (every class counts
    alike); returns the best model, refitted on all rows, and (params, mean F1) rows."""
    pipe = classifier_pipeline(numeric, categorical, label)
    lr = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = CrossValidator(
        estimator=pipe,
        estimatorParamMaps=grid,
        evaluator=MacroF1(),
        numFolds=folds,
        parallelism=2,
        seed=SEED,
    )
    model = cv.fit(stored(df.select(label, *numeric, *categorical), "grid"))
    rows = []
    for pm, metric in zip(grid, model.avgMetrics):
        rows.append((float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(metric)))
    return model.bestModel, rows


class MacroF1(Evaluator):
    """Macro F1 of the columns ``label`` and ``prediction``, from one aggregate."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(macro_f1(dataset, "label", "prediction").first()["macro_f1"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def predictions(spark: SparkSession, model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select("user_id", "label", "prediction")
