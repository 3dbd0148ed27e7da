"""The registered queries of this package: ``QUERIES`` and, where SQL can say
the same thing, ``ORACLES`` (DuckDB)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


QUERIES["op10_byte_bpe"] = op10_byte_bpe


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op6_simhash_dedup"] = op6_simhash_dedup


def op5_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.quality import rated

    return rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op5_quality_ranking"] = op5_quality_ranking


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.langid import identified

    return identified(table(spark, sf_dir, "documents"))


QUERIES["op7_language_mixture"] = op7_language_mixture


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.postings import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op4_decontamination"] = op4_decontamination
ORACLES["op4_decontamination"] = r"""
WITH low AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p
),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), p) AS w FROM documents, low),
t AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), p) AS w FROM benchmark, low),
tw AS (
  SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT item_id, w, least(len(w), 10) AS k FROM t WHERE len(w) > 0))
),
dw AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM tw) WHERE len(w) >= k)
),
hits AS (SELECT dw.doc_id, dw.i, dw.k, tw.item_id FROM dw JOIN tw ON dw.k = tw.k AND dw.g = tw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op9_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.vectors import nearest, usable

    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES["op9_block_matrix_neighbours"] = op9_block_matrix_neighbours
ORACLES["op9_block_matrix_neighbours"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 20 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.wordpiece import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


QUERIES["op1_token_counts"] = op1_token_counts


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.repeats import digest

    return digest(table(spark, sf_dir, "documents"))


QUERIES["op8_repeated_passages"] = op8_repeated_passages
ORACLES["op8_repeated_passages"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + 49) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1),
cut AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM (SELECT win.doc_id, win.i FROM win JOIN low ON win.g = low.g WHERE low.first < win.doc_id)
),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s
  FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id) c USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.pitman_yor import scored

    return scored(table(spark, sf_dir, "documents"))


QUERIES["op2_pitman_yor"] = op2_pitman_yor


def op3_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.pii import digest

    return digest(table(spark, sf_dir, "documents"))


QUERIES["op3_boosted_pii"] = op3_boosted_pii


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.negatives import hard_negatives, usable

    return hard_negatives(usable(table(spark, sf_dir, "embeddings")))


QUERIES["op11_hard_negatives"] = op11_hard_negatives
ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, len(embedding) AS dim,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, a.label = c.label AS same,
         CASE WHEN a.dim = 0 THEN 0 ELSE CAST(list_inner_product(a.x, c.x) AS BIGINT) END AS score
  FROM v a JOIN v c ON a.r <> c.r AND a.dim = c.dim
  WHERE a.vec_id % 100 = 0
),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS nth FROM s WHERE same) WHERE nth <= 5
),
neg AS (
  SELECT pos.anchor_id, pos.vec_id AS positive_id, s.vec_id AS negative_id, pos.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY pos.a, pos.nth ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos JOIN s ON pos.a = s.a AND NOT s.same
  WHERE 100 * s.score BETWEEN 30 * pos.score AND 90 * pos.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"))


QUERIES["op13_best_fit_packing"] = op13_best_fit_packing


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.llm.variants import grouped

    return grouped(table(spark, sf_dir, "documents"))


QUERIES["op12_spelling_variants"] = op12_spelling_variants
