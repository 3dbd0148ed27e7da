"""Model checks (fits have no SQL twin; what is exact around them has). Each reads the test
tables through the stand-ins, fits distributed MLlib models and returns a
small DataFrame of results."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.catalog.usage import WIDE_CTE, wide_users
from featuremart.models import age_group as ag
from featuremart.models import cancellation as cm
from featuremart.models import sales_model as sm
from featuremart.models.fitting import fitted, scored, spread
from featuremart.models.kernel import RandomFourierFeatures
from featuremart.models.search import successive_halving
from featuremart.operators.target_stats import ordered_target_statistics, target_statistics, with_target_statistics
from featuremart.plans import bookings as bk
from featuremart.plans import forecast as fc
from featuremart.plans import usage as us
from featuremart.session import shared_dir, stored
from featuremart.sources import hotel
from featuremart.sources import sales as sl
from featuremart.sources.hotel import SQL_CTES as HOTEL_CTES
from featuremart.sources.sales import SQL_CTES as SALES_CTES
from featuremart.sources.standins import table
from featuremart.sources.usage import SQL_CTES as USAGE_CTES

NUMERIC = (
    "visits", "avg_value", "std_value", "min_value", "max_value", "n_categories", "share_view", "share_click",
    "share_purchase", "share_signup", "share_error", "n_orders", "order_amount", "n_lines", "quantity", "acctbal",
)
CATEGORICAL = ("region",)
LABEL = "segment"
VALIDATION_FROM = "2000-06-01"
TEST_FROM = "2000-09-01"


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/featuremart-models/{name}-{uuid.uuid4().hex}"


def _users(spark, sf_dir):
    return ag.prepare(wide_users(spark, sf_dir), NUMERIC, LABEL)


def _split(df, key="user_id"):
    """Train and test rows by a hash of the id: the same on every run and layout."""
    part = F.pmod(F.xxhash64(key), F.lit(5))
    return df.where(part < 4), df.where(part == 4)


def _judged(pipeline, train, test, *names):
    """label and prediction (and further columns) of the test rows, stored once."""
    return scored(fitted(pipeline, train), test, [*names, "label", "prediction"])


@register("age_pipeline")
def age_pipeline(spark, sf_dir):
    train, test = _split(_users(spark, sf_dir))
    return us.class_report(_judged(ag.classifier_pipeline(NUMERIC, CATEGORICAL, LABEL), train, test), "label", "prediction")


def _macro_f1s(spark, judged):
    """One row a model: macro_f1, classes, n of its stored predictions."""
    rows = [(*us.macro_f1(df, "label", "prediction").first(), name) for name, df in judged]
    return spark.createDataFrame(rows, "macro_f1 double, classes long, n long, model string")


@register("multiclass_models")
def multiclass_models(spark, sf_dir):
    train, test = _split(stored(_users(spark, sf_dir), "users"))
    models = ("logreg", "linear_svc", "rbf_svc")
    return _macro_f1s(spark, [(m, _judged(ag.classifier_pipeline(NUMERIC, CATEGORICAL, LABEL, m), train, test)) for m in models])


# Radii (in standard deviations, squared) that end the inner disc and the ring.
RING = (0.5, 1.6)
# Customers whose 256 Fourier features one task of a fit holds (80 MB).
RING_ROWS_PER_TASK = 40_000
# Pairs, each of two vectors of 1,024 features, that one task sends through Python (80 MB).
PAIRS_PER_TASK = 5_000


def _rings(spark, sf_dir):
    """Customers by balance and order amount, classed by their distance from the
    mean customer: no straight line tells the ring from the disc inside it."""
    u = wide_users(spark, sf_dir).select("user_id", F.col("acctbal").cast("double").alias("x"), F.coalesce(F.col("order_amount").cast("double"), F.lit(0.0)).alias("y"))
    u = stored(u.where("x is not null"), "rings")
    m = u.agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]).first()
    z = {c: (F.col(c) - m[f"mean_{c}"]) / (m[f"sd_{c}"] or 1.0) for c in ("x", "y")}
    r2 = F.pow("x", F.lit(2.0)) + F.pow("y", F.lit(2.0))
    return u.withColumns(z).withColumn("ring", F.when(r2 < RING[0], "disc").when(r2 < RING[1], "ring").otherwise("outside"))


@register(
    "rbf_ring",
    "SELECT count(*) AS n, 3 AS classes, true AS rbf_above_linear FROM customer WHERE c_acctbal IS NOT NULL AND c_custkey % 5 = 4",
)
def rbf_ring(spark, sf_dir):
    """Held-out macro F1 of the radial machine is above the linear one's."""
    rows = stored(_rings(spark, sf_dir), "ring-rows")
    train, test = spread(rows.where("user_id % 5 <> 4"), RING_ROWS_PER_TASK), rows.where("user_id % 5 = 4")
    f1 = {}
    for model in ("linear_svc", "rbf_svc"):
        judged = _judged(ag.classifier_pipeline(("x", "y"), (), "ring", model), train, test)
        f1[model] = us.macro_f1(judged, "label", "prediction").first()
    best = f1["rbf_svc"]
    above = best["macro_f1"] > f1["linear_svc"]["macro_f1"]
    return spark.createDataFrame([(best["n"], best["classes"], above)], "n long, classes int, rbf_above_linear boolean")


@register(
    "rbf_kernel",
    """SELECT count(*) AS pairs, true AS within FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
WHERE a.c_acctbal IS NOT NULL AND b.c_acctbal IS NOT NULL""",
)
def rbf_kernel(spark, sf_dir):
    """Inner products of Fourier features against the exact radial kernel, for every
    customer and the next one: the mean error is below twice ``1 / sqrt(dimensions)``."""
    size = 1024
    rows = stored(_rings(spark, sf_dir).select("user_id", F.array("x", "y").alias("v")), "ring-points")
    # pairs are made of the points: features are 500 times as wide, and no shuffle carries them
    pairs = rows.join(rows.select((F.col("user_id") - 1).alias("user_id"), F.col("v").alias("w")), "user_id")
    pairs = spread(stored(pairs, "ring-pairs"), PAIRS_PER_TASK)
    for of, to in (("v", "f"), ("w", "g")):
        features = RandomFourierFeatures(inputCol="features", outputCol="fourier", dimensions=size, gamma=0.5)
        pairs = features.transform(pairs.withColumn("features", array_to_vector(of))).withColumn(to, vector_to_array("fourier")).drop("features", "fourier")
    dot = F.aggregate(F.zip_with("f", "g", lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    apart = F.aggregate(F.zip_with("v", "w", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x)
    error = F.abs(dot - F.exp(-0.5 * apart))
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), (F.avg(error) < 2 / size**0.5).alias("within"))


SEARCH = [{"regParam": reg, "elasticNetParam": mix} for reg in (0.0, 0.01, 0.1) for mix in (0.0, 0.5, 1.0)]


def _logistic_f1(rows, validation, setting):
    pipe = ag.classifier_pipeline(NUMERIC, CATEGORICAL, LABEL)
    for name, value in setting.items():
        pipe.getStages()[-1].set(pipe.getStages()[-1].getParam(name), value)
    judged = _judged(pipe, rows, validation)
    return float(us.macro_f1(judged, "label", "prediction").first()["macro_f1"] or 0.0)


@register("adaptive_search")
def adaptive_search(spark, sf_dir):
    """Trials of a successive-halving search over the age model's regularisation."""
    train, held = _split(_users(spark, sf_dir))
    _, trials = successive_halving(train, held, "user_id", SEARCH, _logistic_f1, eta=3)
    rows = [(t.round, t.share, SEARCH[t.setting]["regParam"], SEARCH[t.setting]["elasticNetParam"], t.score, t.kept) for t in trials]
    return spark.createDataFrame(rows, "round int, share double, reg_param double, elastic_net double, score double, kept boolean")


# F = between-class over within-class mean square, per numeric column.
_LONG_NUMERIC = "\n  UNION ALL\n  ".join(f"SELECT segment AS c, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM u_wide" for f in NUMERIC)
ANOVA_CTES = with_ctes(
    USAGE_CTES,
    WIDE_CTE,
    f"""long AS (
  {_LONG_NUMERIC}
),
per AS (SELECT feature, c, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM long
        WHERE x IS NOT NULL AND c IS NOT NULL GROUP BY feature, c),
tot AS (SELECT feature, sum(n * m) / sum(n) AS mean FROM per GROUP BY feature),
f_values AS (
  SELECT per.feature, (sum(n * (m - mean) * (m - mean)) / (count(*) - 1)) / nullif(sum(ss) / (sum(n) - count(*)), 0) AS f_value
  FROM per JOIN tot ON per.feature = tot.feature GROUP BY per.feature
)""",
    select="",
).rstrip() + "\n"


@register("anova_f", ANOVA_CTES + "SELECT feature, round(f_value, 4) AS f_value FROM f_values")
def anova_f(spark, sf_dir):
    return rounded(ag.anova_f(_users(spark, sf_dir), NUMERIC, LABEL), {"f_value": 4})


@register(
    "select_k_best",
    ANOVA_CTES
    + """SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY f_value DESC NULLS LAST, feature) AS INTEGER) AS rank, feature FROM f_values
) WHERE rank <= 8""",
)
def select_k_best(spark, sf_dir):
    chosen = ag.select_k_best(_users(spark, sf_dir), NUMERIC, LABEL, k=8)
    return spark.createDataFrame([(i + 1, c) for i, (c, _) in enumerate(chosen)], "rank int, feature string")


@register("rfe")
def rfe(spark, sf_dir):
    steps = ag.recursive_elimination(_users(spark, sf_dir), NUMERIC, LABEL, target=12)
    return spark.createDataFrame(steps, "step int, dropped string, remaining int")


@register("grid_search")
def grid_search(spark, sf_dir):
    train, test = _split(_users(spark, sf_dir))
    best, rows = ag.grid_search(train, NUMERIC, CATEGORICAL, LABEL, folds=3)
    test_f1 = us.macro_f1(best.transform(test), "label", "prediction").first()["macro_f1"]
    out = spark.createDataFrame(rows, "reg_param double, elastic_net double, mean_f1 double")
    return out.withColumn("best_test_f1", F.lit(test_f1).cast("double"))


@register("model_reload", "SELECT count(*) AS rows, count(*) AS agreeing FROM customer WHERE c_mktsegment IS NOT NULL")
def model_reload(spark, sf_dir):
    data = stored(_users(spark, sf_dir), "users")
    model = ag.classifier_pipeline(NUMERIC, CATEGORICAL, LABEL).fit(data)
    loaded = ag.save_and_reload(model, _scratch(spark, "age"))
    a = model.transform(data).select("user_id", F.col("prediction").alias("p1"))
    b = loaded.transform(data).select("user_id", F.col("prediction").alias("p2"))
    return a.join(b, "user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p1") == F.col("p2")).alias("agreeing")
    )


CANCEL_NUMERIC = ("stay_nights", "arrival_month", "arrival_dow", "prior_bookings", "prior_cancellations", "price_d")


def _bookings(spark, sf_dir):
    b = stored(hotel.bookings(spark, sf_dir), "order-bookings")  # read three times
    stay = bk.stay_features(b).select("booking_id", "arrival_month", "arrival_dow")
    prior = bk.prior_bookings(b).select("booking_id", "prior_bookings", "prior_cancellations")
    reviews = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("booking_id"), F.col("text").alias("review"))
    return (
        b.join(stay, "booking_id").join(prior, "booking_id").join(reviews, "booking_id", "left")
        .withColumns({
            "review": F.coalesce("review", F.lit("")),
            "label": F.col("is_canceled").cast("double"),
            "price_d": F.col("price").cast("double"),
            **{c: F.col(c).cast("double") for c in ("stay_nights", "arrival_month", "arrival_dow", "prior_bookings",
                                                    "prior_cancellations")},
        })
    )


# Shares of the arrival span that end the training and the calibration part.
SPLIT_AT = (0.6, 0.8)


def _by_time(df, stored_as=None):
    """``df`` with ``part``: train, then calibrate, then test by arrival. With
    ``stored_as`` its rows are computed once: stored before the span is asked for."""
    df = stored(df, stored_as) if stored_as else df
    span = df.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi")).first()
    cuts = [F.lit(span["lo"] + (span["hi"] - span["lo"]) * f) if span["lo"] else F.lit(None) for f in SPLIT_AT]
    cuts = [c.cast("timestamp_ntz") for c in cuts]
    part = F.when(F.col("arrival") < cuts[0], "train").when(F.col("arrival") < cuts[1], "calibrate").otherwise("test")
    return df.withColumn("part", part)


def _cancel_rows(spark, sf_dir):
    """Bookings with their part and review vector; texts are split into words once,
    text stages fitted once, on the earliest bookings, for all models."""
    words, weights = cm.text_stages()[:cm.WORD_STAGES], cm.text_stages()[cm.WORD_STAGES:]
    texts = _bookings(spark, sf_dir).where("arrival is not null")
    keep = [c for c in texts.columns if c != "review"]
    hashed = PipelineModel(words).transform(texts).select(*keep, words[-1].getOutputCol())
    data = _by_time(hashed, "bookings")
    text = fitted(Pipeline(stages=weights), data.where("part = 'train'"))
    return scored(text, data, [*keep, "part", "review_tfidf"])


SCORED = ("booking_id", "price", "stay_nights", "is_canceled", "part", "label", "prediction")


def _cancel_fit(rows, model="rf"):
    """The model fitted on the earliest bookings, and the later ones scored by it."""
    trees = fitted(Pipeline(stages=cm.tree_stages(CANCEL_NUMERIC, model)), spread(rows.where("part = 'train'")))
    later = scored(trees, rows.where("part <> 'train'"), [*SCORED, vector_to_array("probability")[1].alias("score")])
    return trees, later


@register(
    "cancel_split",
    with_ctes(
        HOTEL_CTES,
        """span AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM h_book),
cut AS (SELECT lo + to_microseconds(CAST(date_diff('microsecond', lo, hi) * 0.6 AS BIGINT)) AS c1,
               lo + to_microseconds(CAST(date_diff('microsecond', lo, hi) * 0.8 AS BIGINT)) AS c2 FROM span)""",
        select="""SELECT CASE WHEN arrival < c1 THEN 'train' WHEN arrival < c2 THEN 'calibrate' ELSE 'test' END AS part,
       count(*) AS rows, count(*) FILTER (WHERE is_canceled) AS canceled
FROM h_book, cut WHERE arrival IS NOT NULL GROUP BY 1""",
    ),
)
def cancel_split(spark, sf_dir):
    data = _by_time(hotel.bookings(spark, sf_dir).where("arrival is not null"))
    return data.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_canceled")).alias("canceled"))


@register("cancel_model")
def cancel_model(spark, sf_dir):
    rows = _cancel_rows(spark, sf_dir)
    return _macro_f1s(spark, [(m, _cancel_fit(rows, m)[1].where("part = 'test'")) for m in ("rf", "gbt")])


def _calibrated(spark, sf_dir):
    """(calibration rows, test rows), both with a score calibrated on the former."""
    _, later = _cancel_fit(_cancel_rows(spark, sf_dir))
    out = cm.platt_calibrate(later.where("part = 'calibrate'"), later)[0]
    out = stored(out.select(*SCORED, "score", "calibrated"), "calibrated")
    return out.where("part = 'calibrate'"), out.where("part = 'test'")


@register("platt")
def platt(spark, sf_dir):
    _, test = _calibrated(spark, sf_dir)
    bucket = F.least(F.floor(F.col("calibrated") * 10), F.lit(9)).cast("int")
    return test.groupBy(bucket.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("calibrated").alias("mean_calibrated"), F.avg("label").alias("observed")
    )


@register("importance")
def importance(spark, sf_dir):
    rows = _cancel_rows(spark, sf_dir)
    trees, _ = _cancel_fit(rows)
    return spark.createDataFrame(cm.feature_importance(trees, trees.stages[0].transform(rows)), "feature string, importance double")


@register("forecast_model")
def forecast_model(spark, sf_dir):
    """Fitted on the weeks before VALIDATION_FROM, stopped early on those before
    TEST_FROM, judged on the rest."""
    history, feats = sl.sales(spark, sf_dir), sl.store_features(spark, sf_dir)
    data = stored(sm.training_frame(history, feats), "sales-frame")
    week = F.col("week")
    since = lambda d: week >= F.lit(d).cast("timestamp_ntz")
    train = spread(data.where(~since(TEST_FROM)), sm.ROWS_PER_TASK)
    model = sm.forecaster().fit(train.withColumn("is_validation", since(VALIDATION_FROM)))
    return fc.regression_metrics(model.transform(data.where(since(TEST_FROM))), "label", "prediction")


def _forecasts(spark, sf_dir):
    return sm.forecast_run(
        sl.sales(spark, sf_dir), sl.store_features(spark, sf_dir), _scratch(spark, "gbt"),
        _scratch(spark, "forecasts"), VALIDATION_FROM,
    )


@register("forecast_batch")
def forecast_batch(spark, sf_dir):
    return _forecasts(spark, sf_dir)


@register(
    "forecast_keys",
    with_ctes(SALES_CTES, select="SELECT store_id, dept, week, true AS usable FROM f_plan WHERE is_plan"),
)
def forecast_keys(spark, sf_dir):
    """Every plan week of every series has one forecast, none negative."""
    f = _forecasts(spark, sf_dir)
    return f.select("store_id", "dept", "week", F.coalesce(F.col("forecast") >= 0, F.lit(False)).alias("usable"))


@register("cancel_policy")
def cancel_policy(spark, sf_dir):
    """Calibrated scores → best threshold by incremental revenue on the
    calibration rows → before/after outcome at it on the later test rows."""
    grid = hotel.GRID

    def bucketed(df):
        return df.select(
            "booking_id", "price", "stay_nights", F.col("is_canceled"),
            F.least(F.floor(F.col("calibrated") * grid), F.lit(grid)).cast("int").alias("score_bucket"),
        )

    held, test = _calibrated(spark, sf_dir)
    sweep = bk.threshold_sweep(bucketed(held), grid=grid)
    best_k = sweep.where("is_best").select((F.col("threshold") * grid).cast("int")).first()[0]
    outcome = bk.policy_outcome(bucketed(test), grid=grid, k=best_k)
    return outcome.withColumn("threshold", F.lit(best_k / grid)).withColumn("revenue", F.col("revenue").cast("double"))


@register("time_cv")
def time_cv(spark, sf_dir):
    """Time-ordered cross-validation: one fit per expanding fold (a loop over
    folds, each fit distributed), scored on the following periods."""
    # every fold reads the same rows: one per booking, without the review text
    narrow = _bookings(spark, sf_dir).select("booking_id", "arrival", "label", *CANCEL_NUMERIC)
    data = stored(bk.with_period_index(narrow), "folds")
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(CANCEL_NUMERIC), outputCol="raw", handleInvalid="keep"),
        StandardScaler(inputCol="raw", outputCol="features"),
        LogisticRegression(labelCol="label", maxIter=50),
    ])
    rows = []
    for k in range(1, 6):
        split = bk.split_of_fold(k, 5)
        judged = _judged(pipe, data.where(split == "train"), data.where(split == "test"))
        rows.append((*us.macro_f1(judged, "label", "prediction").first(), k))
    return spark.createDataFrame(rows, "macro_f1 double, classes long, n long, fold int")


# Categories of a booking: those of its customer and of its arrival.
BOOKING_CATEGORIES = ("segment", "nation", "arrival_dow")


def _category_bookings(spark, sf_dir):
    b = hotel.bookings(spark, sf_dir).where("arrival is not null")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return b.join(c, "customer_id", "left").withColumns({"arrival_dow": F.dayofweek("arrival"), "label": F.col("is_canceled").cast("double")})


_TS_LONG = " UNION ALL ".join(
    f"SELECT booking_id, '{c}' AS col, CAST({c} AS VARCHAR) AS v, y, md5('0:' || CAST(booking_id AS VARCHAR)) AS place FROM ts_book" for c in BOOKING_CATEGORIES
)


@register(
    "ordered_target_stats",
    with_ctes(
        HOTEL_CTES,
        """ts_book AS (
  SELECT booking_id, c_mktsegment AS segment, c_nationkey AS nation, dayofweek(arrival) + 1 AS arrival_dow, CAST(is_canceled AS DOUBLE) AS y
  FROM h_book LEFT JOIN customer ON customer_id = c_custkey WHERE arrival IS NOT NULL
)""",
        f"ts_long AS ({_TS_LONG})",
        """ts_before AS (
  SELECT booking_id, col, coalesce(sum(y) OVER w, 0) AS s, count(*) OVER w AS n, (SELECT avg(y) FROM ts_book) AS p FROM ts_long WHERE y IS NOT NULL
  WINDOW w AS (PARTITION BY col, v ORDER BY place, booking_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)""",
        select="SELECT booking_id, "
        + ", ".join(f"round(max((s + p) / (n + 1)) FILTER (WHERE col = '{c}'), 9) AS {c}_ts" for c in BOOKING_CATEGORIES)
        + " FROM ts_before GROUP BY booking_id",
    ),
)
def ordered_target_stats(spark, sf_dir):
    out = ordered_target_statistics(_category_bookings(spark, sf_dir), "booking_id", "label", BOOKING_CATEGORIES)
    return rounded(out, {f"{c}_ts": 9 for c in BOOKING_CATEGORIES})


@register("ordered_boosting")
def ordered_boosting(spark, sf_dir):
    """Boosted trees on the booking's numbers and its categories as target
    statistics: ordered ones in training, those of all training rows after."""
    rows = _by_time(_category_bookings(spark, sf_dir), "category-bookings").withColumns({c: F.col(c).cast("double") for c in ("stay_nights", "price")})
    train = rows.where("part = 'train'")
    own = ordered_target_statistics(train, "booking_id", "label", BOOKING_CATEGORIES)
    later = with_target_statistics(rows.where("part = 'test'"), target_statistics(train, "label", BOOKING_CATEGORIES), BOOKING_CATEGORIES)
    inputs = ["stay_nights", "price", *[f"{c}_ts" for c in BOOKING_CATEGORIES]]
    pipe = Pipeline(stages=cm.tree_stages(inputs, "gbt", vectors=()))
    return _macro_f1s(spark, [("gbt_ordered", _judged(pipe, spread(stored(train.join(own, "booking_id"), "ordered-train")), later))])
