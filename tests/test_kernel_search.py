"""Radial kernel features, adaptive search, target statistics and phi_k on small data."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featuremart.models import age_group as ag
from featuremart.models.fitting import fitted, scored
from featuremart.models.kernel import RandomFourierFeatures, fourier
from featuremart.models.search import row_fits, share_of_rows, shares, successive_halving
from featuremart.operators import phik
from featuremart.operators.target_stats import ordered_target_statistics, target_statistics, with_target_statistics
from featuremart.plans.usage import macro_f1
from featuremart.session import shared_dir


@pytest.mark.parametrize("gamma", [0.1, 0.5, 2.0])
def test_fourier_features_estimate_the_kernel(gamma):
    x = np.random.default_rng(1).normal(size=(80, 5))
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    errors = []
    for size in (64, 4096):
        z = fourier(x, size, gamma, 3)
        errors.append(np.abs(z @ z.T - exact).mean())
    assert errors[1] < 1.5 / math.sqrt(4096) and errors[1] < errors[0] / 4


@pytest.fixture(scope="module")
def rings(spark):
    r = np.random.default_rng(5)
    rows = []
    for i in range(600):
        radius, angle = [0.4, 1.5, 3.0][i % 3] + r.normal() * 0.15, r.uniform(0, 2 * np.pi)
        rows.append((i, float(radius * np.cos(angle)), float(radius * np.sin(angle)), "abc"[i % 3]))
    return spark.createDataFrame(rows, "id long, x double, y double, ring string")


def test_rbf_machine_tells_rings_apart(spark, rings):
    train, test = rings.where("id % 4 <> 0"), rings.where("id % 4 = 0")
    f1 = {}
    for model in ("linear_svc", "rbf_svc"):
        judged = scored(fitted(ag.classifier_pipeline(("x", "y"), (), "ring", model), train), test, ["label", "prediction"])
        f1[model] = macro_f1(judged, "label", "prediction").first()["macro_f1"]
    assert f1["rbf_svc"] > 0.9 > 0.75 > f1["linear_svc"]


def test_fourier_stage_is_saved_with_its_pipeline(spark, rings):
    rows = rings.withColumn("features", array_to_vector(F.array("x", "y")))
    stages = [RandomFourierFeatures(dimensions=32, gamma=0.7, seed=9), OneVsRest(featuresCol="fourier", labelCol="id3", classifier=LinearSVC(featuresCol="fourier", maxIter=3))]
    rows = rows.withColumn("id3", (F.col("id") % 3).cast("double"))
    model = Pipeline(stages=stages).fit(rows)
    path = f"{shared_dir(spark)}/featuremart-test/rff"
    model.write().overwrite().save(path)
    a, b = (m.transform(rows).select("id", "prediction").orderBy("id").collect() for m in (model, PipelineModel.load(path)))
    assert a == b
    assert RandomFourierFeatures(dimensions=8).transform(rows.limit(0)).count() == 0


def test_halving_finds_what_the_full_grid_finds(spark):
    """Scores that rise with the rows and favour one setting: same winner, less work."""
    rows = spark.range(9000).withColumn("x", F.lit(1.0))
    grid = [{"k": k} for k in range(9)]
    calls = []

    def score(part, validation, setting):
        calls.append((setting["k"], part.count()))
        return -abs(setting["k"] - 6) + calls[-1][1] / 1e6

    best, trials = successive_halving(rows, rows, "id", grid, score, eta=3)
    assert best == max(grid, key=lambda s: -abs(s["k"] - 6)) and row_fits(trials) == pytest.approx(1 + 1 + 1)
    assert [sum(t.round == r for t in trials) for r in (0, 1, 2)] == [9, 3, 1]
    assert [t.setting for t in trials if t.round == 2 and t.kept] == [6]
    per_round = {t.round: t.share for t in trials}
    assert all(abs(n / 9000 - share) < 0.03 for (k, n), share in zip(sorted(calls, key=lambda c: c[1]), sorted(t.share for t in trials)))
    small, large = (share_of_rows(rows, "id", s) for s in (per_round[0], per_round[1]))
    assert small.join(large, "id", "left_anti").count() == 0  # shares are nested
    assert shares(1, 3) == [1.0] and shares(10, 3) == pytest.approx([1 / 27, 1 / 9, 1 / 3, 1])
    with pytest.raises(ValueError):
        successive_halving(rows, rows, "id", [], score)


def test_ordered_target_statistics_see_earlier_rows_only(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "a", "a", None, "b", "c"]), r.randrange(3), float(r.random() < 0.3) if i % 17 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, c string, d int, y double")
    got = {x["id"]: (x["c_ts"], x["d_ts"]) for x in ordered_target_statistics(df, "id", "y", ["c", "d"], weight=2.0, seed=4).collect()}
    labelled = sorted((x for x in rows if x[3] is not None), key=lambda x: (hashlib.md5(f"4:{x[0]}".encode()).hexdigest(), x[0]))
    prior = sum(x[3] for x in labelled) / len(labelled)
    sums = {}
    for i, c, d, y in labelled:
        want = []
        for key in (("c", c), ("d", d)):
            s, n = sums.get(key, (0.0, 0))
            want.append((s + 2 * prior) / (n + 2))
            sums[key] = (s + y, n + 1)
        assert got[i] == pytest.approx(want)
    assert len(got) == len(labelled)
    stats = target_statistics(df, "y", ["c", "d"], weight=2.0)
    new = spark.createDataFrame([(1, "a", 9), (2, None, 0), (3, "z", None)], "id long, c string, d int")
    later = {x["id"]: x for x in with_target_statistics(new, stats, ["c", "d"]).collect()}
    s, n = sums[("c", "a")]
    assert later[1]["c_ts"] == pytest.approx((s + 2 * prior) / (n + 2)) and later[1]["d_ts"] == pytest.approx(prior)
    s, n = sums[("c", None)]
    assert later[2]["c_ts"] == pytest.approx((s + 2 * prior) / (n + 2)) and later[3]["c_ts"] == pytest.approx(prior)


def test_normal_chi2_against_a_plain_double_sum():
    """Cells of the bivariate density summed over a fine square grid."""
    for rho, r, k in ((0.0, 3, 4), (0.3, 5, 2), (0.8, 4, 4)):
        n = 1200
        x = -5 + (np.arange(n) + 0.5) * 10 / n
        density = np.exp(-(x[:, None] ** 2 - 2 * rho * x[:, None] * x + x**2) / (2 * (1 - rho**2))) / (2 * np.pi * math.sqrt(1 - rho**2)) * (10 / n) ** 2
        cells = density.reshape(r, n // r, k, n // k).sum(axis=(1, 3))
        apart = np.outer(cells.sum(axis=1), cells.sum(axis=0))
        assert phik.normal_chi2(rho, r, k) == pytest.approx(((cells - apart) ** 2 / apart).sum(), rel=2e-3, abs=1e-6)
    grid = [phik.normal_chi2(x, 6, 9) for x in (0, 0.2, 0.5, 0.9, 0.99, 1.0)]
    assert grid == sorted(grid)


def test_phi_k_recovers_the_correlation_of_a_normal():
    """Expected counts of a binned normal: its own correlation comes back, but for the
    pedestal and the largest value, which both vanish in its share for many rows."""
    for rho in (0.2, 0.6, 0.95):
        r, k, n = 10, 10, 10**9
        share = phik.normal_chi2(rho, r, k) / phik.normal_chi2(1.0, r, k)
        chi2 = (r - 1) * (k - 1) + share * (n * (min(r, k) - 1) - (r - 1) * (k - 1))
        assert phik.from_chi2(chi2, n, r, k) == pytest.approx(rho, abs=1e-6)
    assert phik.from_chi2(5.0, 100, 1, 4) is None and phik.from_chi2(3.0, 100, 3, 3) == 0.0 and phik.from_chi2(200.0, 100, 3, 3) == 1.0


def test_phi_k_of_columns(spark):
    r = random.Random(3)
    rows = []
    for i in range(4000):
        a = r.choice("uvwx")
        rows.append((a, a if r.random() < 0.7 else r.choice("uvwx"), r.choice("pq"), r.gauss(0, 1) + "uvwx".index(a), None if i % 9 else 1.0, "same"))
    df = spark.createDataFrame(rows, "a string, b string, c string, x double, y double, s string")
    got = {(x["col_a"], x["col_b"]): x for x in phik.phi_k(df, ["a", "b", "c", "s"], ["x", "y"]).collect()}
    assert got[("a", "b")]["phi_k"] > 0.7 > 0.1 > got[("a", "c")]["phi_k"] and got[("a", "x")]["phi_k"] > 0.5
    assert got[("a", "s")]["phi_k"] is None and got[("a", "y")]["n"] == sum(x[4] is not None for x in rows)
    assert len(got) == 15
