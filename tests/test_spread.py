"""Rows dealt evenly over the tasks of a fit, whatever files they lie in."""

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from featuremart.catalog import models
from featuremart.models import fitting
from featuremart.models import sales_model as sm
from featuremart.models.kernel import RandomFourierFeatures, fourier
from featuremart.operators import quantiles
from featuremart.session import stored


def _sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_rows_of_one_file_are_dealt_over_tasks(spark):
    rows = stored(spark.range(10_000).withColumn("k", F.lit(None).cast("long")).coalesce(1), "one-file")
    dealt = fitting.spread(rows, 500)
    assert len(_sizes(dealt)) == 20 and max(_sizes(dealt)) <= 600
    assert sorted(r["id"] for r in dealt.collect()) == list(range(10_000))


def test_few_rows_stay_as_they_lie(spark):
    rows = stored(spark.range(100).coalesce(1), "few")
    assert fitting.spread(rows, 100) is rows


def test_forecast_fit_reads_bounded_tasks(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    class Spy:
        def fit(self, data):
            seen.append(_sizes(data))
            raise Stop

    monkeypatch.setattr(sm, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(sm, "forecaster", lambda: Spy())
    days = F.expr("timestamp_ntz'2000-01-03 00:00:00' + make_dt_interval(cast(id % 60 as int) * 7)")
    history = spark.range(6_000).select((F.col("id") % 5).alias("store_id"), F.concat(F.lit("d"), F.floor(F.col("id") / 60)).alias("dept"), days.alias("week"), F.lit(1).cast("decimal(18,2)").alias("sales"))
    feats = history.select("store_id", "week", F.lit(2).cast("long").alias("store_lines"), F.lit(0.1).alias("avg_discount")).distinct()
    try:
        sm.forecast_run(history.coalesce(1), feats, "unused", "unused", "2001-01-01")
    except Stop:
        pass
    assert len(seen[0]) >= 20 and max(seen[0]) <= 400


def test_one_batch_of_features_is_one_array(spark):
    rows = spark.createDataFrame([(i, [i / 7.0, -i / 3.0]) for i in range(50)], "id long, v array<double>")
    stage = RandomFourierFeatures(inputCol="x", outputCol="y", dimensions=16, gamma=0.5)
    got = stage.transform(rows.withColumn("x", array_to_vector("v"))).select("id", "v", vector_to_array("y").alias("y")).collect()
    assert len(got) == 50
    for r in got:
        assert np.allclose(r["y"], fourier(np.array([r["v"]]), 16, 0.5, 42)[0], rtol=0, atol=1e-12)


def test_kernel_pairs_carry_no_features_through_a_shuffle(spark, monkeypatch):
    """Only points and pairs of points are stored, no vector of features."""
    names = []
    keep = models.stored
    monkeypatch.setattr(models, "stored", lambda df, name: names.append((name, df.columns)) or keep(df, name))
    assert models.rbf_kernel(spark, "/root/testdata/sf0.001").first()["within"]
    assert [c for n, c in names if n == "ring-pairs"] == [["user_id", "v", "w"]]
    assert all("f" not in c for _, c in names)


def test_brackets_are_counted_without_their_edges(spark, monkeypatch):
    """The rows of a bracket are aggregated by narrow keys; no edges are sorted along."""
    plans = []
    keep = quantiles.stored

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(quantiles, "RANKED", 50)
    monkeypatch.setattr(quantiles, "PARTS", 4)
    monkeypatch.setattr(quantiles, "stored", spy)
    values = [float(i * i % 1009) for i in range(700)]
    got = quantiles.exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [0.1, 0.5, 0.9]).collect()
    assert {r["p"]: round(r["quantile"], 9) for r in got} == {p: round(float(np.quantile(values, p)), 9) for p in (0.1, 0.5, 0.9)}
    narrowed = [plan for name, plan in plans if name == "brackets"][1:]
    assert narrowed and all("first(" not in plan for plan in narrowed)


def test_backfill_rows_are_dealt_over_tasks(spark, monkeypatch):
    """Customers of one small file, many dates: what a task holds is bounded by rows, not by shuffled bytes."""
    import datetime as dt

    from featuremart.plans import backfill
    from featuremart.sources.tables import CleanSources

    monkeypatch.setattr(backfill, "ROWS_PER_TASK", 100)
    none = spark.range(0)
    at = lambda c: F.lit(None).cast("timestamp_ntz").alias(c)
    clean = CleanSources(
        customers=stored(spark.range(1_000).coalesce(1).select(F.col("id").alias("customer_id"), at("signup_date")), "customers"),
        sessions=none.select(F.col("id").alias("session_id"), F.col("id").alias("customer_id"), at("start_time")),
        events=none.select(F.col("id").alias("event_id"), F.col("id").alias("session_id"), at("timestamp"), F.lit("page_view").alias("event_type"), F.lit("p").alias("product_id")),
        orders=spark.range(500).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("order_time"), F.lit("1.00").alias("total_usd")),
        run_date=dt.datetime(2024, 1, 5),
    )
    out = backfill.build_many(clean, [dt.datetime(2024, 1, d) for d in (1, 3, 5)])
    got = out.withColumn("part", F.spark_partition_id()).collect()
    assert len(got) == 3_000 and sum(r["orders_30"] for r in got) == 1_000
    sizes = {}
    for r in got:
        sizes[r["part"]] = sizes.get(r["part"], 0) + 1
    assert len(sizes) == 30 and max(sizes.values()) <= 200
