"""The DataFrame TF-IDF twin equals MLlib's IDF (ln((m + 1) / (df + 1)))."""

import pytest
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer
from pyspark.sql import functions as F

from featuremart.plans.bookings import TOKEN_SPLIT, review_tfidf
from featuremart.sources.hotel import reviews
from tests.conftest import SF_SMALL


def test_idf_equals_mllib(spark):
    docs = reviews(spark, SF_SMALL)
    ours = {r["term"]: r["idf"] for r in review_tfidf(docs).select("term", "idf").distinct().collect()}
    tok = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=TOKEN_SPLIT, toLowercase=True).transform(docs)
    cv = CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=1 << 20, minDF=1.0).fit(tok)
    idf = IDF(inputCol="tf", outputCol="tfidf").fit(cv.transform(tok))
    mllib = dict(zip(cv.vocabulary, idf.idf.toArray()))
    assert set(mllib) == set(ours)
    for term in list(mllib)[:2000]:
        assert ours[term] == pytest.approx(mllib[term], rel=1e-12)


def test_tf_counts_whole_texts(spark):
    docs = reviews(spark, SF_SMALL)
    total_tokens = review_tfidf(docs).agg(F.sum("tf")).first()[0]
    words = docs.select(F.explode(F.split(F.lower("text"), TOKEN_SPLIT)).alias("w")).where("w <> ''").count()
    assert total_tokens == words


def test_term_of_every_document_is_split(spark):
    """One word in all documents: without broadcasts its join partition is split."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    docs = spark.range(60_000, numPartitions=6).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("every "), F.translate(F.sha2(F.col("id").cast("string"), 256).substr(1, 8), "0123456789", "ghijklmnop")).alias("text"))
    try:
        for k, v in zip(held, ("-1", "64k", "32k", "24")):
            spark.conf.set(k, v)
        out = review_tfidf(docs)
        out.write.format("noop").mode("overwrite").save()
        df = out.select("doc_id", "df").where("term = 'every'") if "term" in out.columns else out
        assert df.where("df = 60000").count() == 60_000
        whole = review_tfidf(docs)
        whole.collect()
        plan = whole._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert "isSkew=true" in plan or "skew=true" in plan
    assert "regexp" not in plan.lower() and "split(" not in plan  # tokenised once, before the join


def test_terms_of_single_texts_are_counted_without_a_shuffle(spark, monkeypatch):
    """Only texts whose doc_id repeats are summed by (doc, term)."""
    from featuremart.plans import bookings

    plans, keep = {}, bookings.stored

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(bookings, "stored", spy)
    schema = "doc_id long, text string"
    texts = [(1, "B a b-B 1a"), (2, ""), (3, None), (4, "12 !"), (5, "a É é")]
    got = {(r["doc_id"], r["term"]): (r["tf"], r["df"]) for r in review_tfidf(spark.createDataFrame(texts, schema)).collect()}
    assert got == {(1, "a"): (2, 2), (1, "b"): (3, 1), (5, "a"): (1, 2), (5, "é"): (2, 1)}
    assert "Exchange" not in plans["tf"]
    # repeated and null ids are summed, as one document each
    more = [*texts, (1, "b c"), (None, "a"), (None, "a c"), (5, None)]
    got = {(r["doc_id"], r["term"]): (r["tf"], r["df"]) for r in review_tfidf(spark.createDataFrame(more, schema)).collect()}
    assert got == {(1, "a"): (2, 3), (1, "b"): (4, 1), (1, "c"): (1, 2), (5, "a"): (1, 3), (5, "é"): (2, 1), (None, "a"): (2, 3), (None, "c"): (1, 2)}
