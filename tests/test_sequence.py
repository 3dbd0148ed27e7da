"""Skew-safe running sums, lags and exact quantiles against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from featuremart.operators.quantiles import exact_quantiles
from featuremart.operators.sequence import lag_within, running_sum_within


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)  # key 0 holds a third of the rows
        if i % 97 == 0:
            key = None
        rows.append((key, i, rnd.randint(0, 5000), float(rnd.randint(0, 50))))
    return spark.createDataFrame(rows, "k long, id long, t long, v double")


def slices():
    return F.floor(F.col("t") / 100)


def _as_map(df, col):
    return {r["id"]: r[col] for r in df.select("id", col).collect()}


def test_running_sum_matches_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = skewed.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    got = running_sum_within(skewed, ["k"], ["t", "id"], "v", "s", inclusive=False, slice_by=slices())
    want_m = {i: (x or 0.0) for i, x in _as_map(want, "s").items()}
    assert _as_map(got, "s") == want_m
    assert got.count() == skewed.count()


def test_lag_matches_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = skewed.withColumn("p", F.lag("t").over(w))
    got = lag_within(skewed, ["k"], ["t", "id"], "t", "p", slice_by=slices())
    assert _as_map(got, "p") == _as_map(want, "p")


def test_hot_key_is_split(spark, skewed):
    out = running_sum_within(skewed, ["k"], ["t", "id"], "v", "s", slice_by=slices())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SPARK_PARTITION_ID" not in plan.upper()
    assert skewed.where("k = 0").select(slices()).distinct().count() > 10


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """1.2M rows in several files, a third of them of one key, with columns that
    no query uses (pruning must not change what is a slice)."""
    path = str(tmp_path_factory.mktemp("large") / "rows")
    rows = spark.range(1_200_000, numPartitions=12).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("k"),
        F.timestamp_add("MINUTE", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2_000_000)).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("t"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100_000_007)).alias("v"),
        F.repeat(F.lit("x"), 40).alias("unused"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _wrong(got, want, col):
    j = got.select("id", F.col(col).alias("a")).join(want.select("id", F.col(col).alias("b")), "id", "full_outer")
    return j.where(~F.col("a").eqNullSafe(F.col("b"))).count()


def test_large_running_sum_and_lag(spark, large):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = large.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert _wrong(running_sum_within(large, ["k"], ["t", "id"], "v", "s"), want, "s") == 0
    want = large.withColumn("p", F.lag("v").over(w))
    assert _wrong(lag_within(large, ["k"], ["t", "id"], "v", "p"), want, "p") == 0


def test_large_exact_quantiles(spark, large):
    """Over the number of values ranked in one task, so brackets are narrowed."""
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    got = {r["p"]: r["quantile"] for r in exact_quantiles(large, "v", probs).collect()}
    want = large.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert [got[p] for p in probs] == pytest.approx(want, rel=1e-12)


def test_a_million_groups(spark):
    """Groups are a stored table: their number is free."""
    df = spark.range(3_000_000).select((F.col("id") % 1_000_000).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"))
    got = exact_quantiles(df, "x", [0.5], by=["g"])
    want = df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("w"))
    assert got.count() == 1_000_000
    assert got.join(want, "g").where(F.abs(F.col("quantile") - F.col("w")) > 1e-9).count() == 0


def test_brackets_of_many_large_groups(spark, skewed, monkeypatch):
    """Every group is narrowed bracket by bracket, null group and ties included."""
    from featuremart.operators import quantiles

    monkeypatch.setattr(quantiles, "RANKED", 3)
    monkeypatch.setattr(quantiles, "PARTS", 4)
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for value in ("t", "v"):
        got = {(r["k"], r["p"]): r["quantile"] for r in exact_quantiles(skewed, value, probs, by=["k"]).collect()}
        want = skewed.groupBy("k").agg(F.percentile(value, F.array(*[F.lit(p) for p in probs])).alias("q")).collect()
        assert len(got) == len(want) * len(probs)
        for r in want:
            assert [got[(r["k"], p)] for p in probs] == pytest.approx(r["q"], abs=1e-9)
    assert exact_quantiles(skewed.where("id < 0"), "t", probs).collect() == []


def test_a_hot_month_is_cut_at_its_quantiles(spark, monkeypatch):
    """A key with a third of all rows inside one month, many of them at one time:
    no slice is much larger than the target, results are those of a plain window."""
    from featuremart.operators import sequence

    monkeypatch.setattr(sequence, "SLICE_ROWS", 2000)
    rows = spark.range(60_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(300))).alias("k"),
        F.when(F.col("id") % 3 == 0, F.timestamp_add("MINUTE", F.least(F.pmod(F.xxhash64("id"), F.lit(30_000)), F.lit(20_000)).cast("int"), F.lit("2024-03-01").cast("timestamp_ntz")))
        .otherwise(F.timestamp_add("HOUR", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000)).cast("int"), F.lit("2023-06-01").cast("timestamp_ntz"))).alias("t"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1009)).alias("v"),
    )
    rows = rows.withColumn("t", F.when(F.col("id") % 50 != 0, F.col("t")))  # some without a time
    s = sequence.sliced(rows, ["k"], ["t", "id"], None, [])
    sizes = [r["_rows"] for r in s.totals.select("_rows").collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 2500
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert _wrong(running_sum_within(rows, ["k"], ["t", "id"], "v", "s"), want, "s") == 0
    want = rows.withColumn("p", F.lag("v").over(w))
    assert _wrong(lag_within(rows, ["k"], ["t", "id"], "v", "p"), want, "p") == 0


def test_exact_quantiles_match_percentile(spark, skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r["k"], r["p"]): r["quantile"] for r in exact_quantiles(skewed, "v", probs, by=["k"]).collect()}
    want = skewed.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()
    for r in want:
        for p, q in zip(probs, r["q"]):
            assert got[(r["k"], p)] == pytest.approx(q, abs=1e-9)
    glob = exact_quantiles(skewed, "t", [0.5, 0.99]).collect()
    ref = skewed.agg(F.percentile("t", F.array(F.lit(0.5), F.lit(0.99)))).collect()[0][0]
    assert sorted(r["quantile"] for r in glob) == pytest.approx(sorted(ref))


def test_approx_quantiles_rank_error(spark, skewed):
    """``percentile_approx`` returns a data value whose rank is within n/accuracy (+1) of p·n."""
    from featuremart.operators.quantiles import approx_quantiles

    probs = [0.1, 0.5, 0.9]
    ap = {(r["k"], r["p"]): r["quantile"] for r in approx_quantiles(skewed, "t", probs, by=["k"]).collect()}
    groups = {}
    for r in skewed.select("k", "t").collect():
        groups.setdefault(r["k"], []).append(r["t"])
    for (k, p), q in ap.items():
        vals = groups[k]
        n = len(vals)
        below = sum(v < q for v in vals)
        at_or_below = sum(v <= q for v in vals)
        slack = n / 10000 + 1
        assert below <= p * n + slack and at_or_below >= p * n - slack, (k, p, q)
