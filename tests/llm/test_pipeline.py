"""The corpus pipeline, stage by stage, and the registered queries."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from featuremart.llm import bpe, postings, quality, simhash

SF = "/root/testdata/sf0.001"


def test_stages_decide_on_what_they_are_given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).persist()
        if name == "quality":
            model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            want = quality.score(before, model).where("score >= 0.5")
            assert {r[0] for r in want.select("doc_id").collect()} == {r[0] for r in after.select("doc_id").collect()}
        elif name == "near_duplicates":
            want = simhash.near_duplicates(before).where("doc_id = component_id")
            assert {r[0] for r in want.select("doc_id").collect()} == {r[0] for r in after.select("doc_id").collect()}
        elif name == "decontamination":
            want = postings.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("not contaminated")
            assert {r[0] for r in want.select("doc_id").collect()} == {r[0] for r in after.select("doc_id").collect()}
        elif name == "pii":
            assert after.count() == before.count()
            assert after.where("n_chars <> length(text)").count() == 0
        else:
            texts = {r["doc_id"]: r["text"] for r in bpe.decode(after).collect()}
            assert texts == {r["doc_id"]: r["text"] for r in before.collect()}
        if name != "bpe":
            assert after.columns == columns
        before = after
    ids = corpus_pipeline.run(spark, SF)
    assert ids.count() == before.count()
    assert ids.exceptAll(before).count() == 0


def test_stages_take_empty_tables_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.withColumns({"score": F.lit("s"), "hash": F.lit(1), "base_spans": F.lit(2), "spans": F.lit("x")})
    for table in (odd.where("false"), odd.limit(5).unionByName(odd.limit(5)).withColumn("text", F.when(F.col("doc_id") != 1, F.col("text")))):
        df = table
        for name, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF).persist()
            if name != "bpe":
                assert df.columns == odd.columns
            df.count()


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
