"""Operator 5: text quality by Bradley-Terry pairwise ranking.

A document's features are plain statistics of its bytes, words and lines.
Preference pairs (a text labelled 1 over one labelled 0) give weights by
logistic loss on feature differences, so the weights rank documents; the cut
between good and bad is the quantile of the training scores that separates
the labels best. score = sigmoid(rank score - cut).

Defined cases: null and empty texts have all-zero statistics and are scored
like any other; null labels and labels of absent documents are ignored;
repeated labels all count; with labels of one kind only (or none) every text
scores 1.0, or 0.0 where only label 0 is known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import LOWER, SAMPLE_STEPS, SPACE_WORDS, id_crc, row_of, row_sums, sample_cut, slices, span_hash, utf8, word_spans

# bound of the labelled sample that the ranking is fitted on, and of its pairs
SAMPLE_ROWS = 20_000
PAIRS = 200_000
QUANTILES = 400

PUNCT = np.array([b for b in range(0x21, 0x7F) if not chr(b).isalnum()])


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics per text."""
    n_rows, size = len(off) - 1, np.diff(off)
    s, e, rows = word_spans(data, off, SPACE_WORDS)
    words = np.diff(rows)
    per_byte = 1.0 / np.maximum(size, 1)
    per_word = 1.0 / np.maximum(words, 1)
    row = row_of(off)
    kind = np.zeros(256, np.int64)  # class of each byte, counted at once
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 4
    kind[10], kind[32] = 5, 6
    kind[PUNCT] = 7 + np.arange(len(PUNCT))
    width = 7 + len(PUNCT)
    counts = np.bincount(row * width + kind[data], minlength=n_rows * width).reshape(n_rows, width) if len(data) else np.zeros((n_rows, width))
    letters = counts[:, 1] + counts[:, 2] + counts[:, 4]
    cols = [np.log1p(size), np.log1p(words), counts[:, 1] / np.maximum(letters, 1), letters * per_byte, counts[:, 3] * per_byte, counts[:, 4] * per_byte]
    cols += [np.log1p(size / np.maximum(counts[:, 5] + 1, 1)), row_sums(e - s, rows) * per_word / 10]
    cols += list(np.sqrt(counts[:, 7:] * per_word[:, None]).T)
    h = span_hash(LOWER[data], s, e)
    doc = row_of(rows)
    same = np.zeros(len(h), np.int64)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    key = np.unique(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    distinct = np.bincount(doc[key], minlength=n_rows) if len(h) else np.zeros(n_rows)
    cols += [np.sqrt(row_sums(same, rows) * per_word), distinct * per_word, distinct / np.sqrt(np.maximum(words, 1)) / 10]
    return np.column_stack(cols).astype(np.float64)


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.cut
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def fit_ranking(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 7, ridge: float = 1.0) -> Ranking:
    """Bradley-Terry weights by Newton steps on pair differences, then the cut."""
    width = x.shape[1] if x.ndim == 2 else 0
    if not (y == 1).any() or not (y == 0).any():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0 if (y == 0).any() else 1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(width)
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -60, 60)))  # probability of the wrong order
        gradient = d.T @ p - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    r = z @ w
    grid = np.unique(np.quantile(r, np.linspace(0, 1, QUANTILES + 1)))
    cuts = (grid[1:] + grid[:-1]) / 2 if len(grid) > 1 else grid
    hit = np.sort(r[good]), np.sort(r[bad])
    right = (len(good) - np.searchsorted(hit[0], cuts)) + np.searchsorted(hit[1], cuts)
    best = np.flatnonzero(right == right.max())
    return Ranking(mean, scale, w, float(cuts[best[len(best) // 2]]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ranking:
    """Fit on at most about ``rows`` labelled texts of ``docs`` (those with the
    smallest hash of the id), never on held-out ones. Where repeated ids make more
    of them, texts of the smallest hash stay, each once."""
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("y")).where(id_crc() % 3 != 1)
    known = known.withColumn("_at", F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_STEPS)))
    sample = known.where(F.col("_at") < sample_cut(known.count(), rows)).orderBy("_at", "doc_id", "y").limit(rows).drop("_at")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
    n = docs.select("doc_id").join(F.broadcast(sample), "doc_id").count()
    if n > rows:
        at = F.pmod(F.xxhash64("doc_id", "y", "text"), F.lit(SAMPLE_STEPS))
        texts = texts.where(at < sample_cut(n, rows)).dropDuplicates(["doc_id", "y", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = features(*utf8(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, y int, x array<double>").toPandas()
    got = got.assign(t=[tuple(v) for v in got["x"]]).sort_values(["doc_id", "y", "t"])
    x = np.array(got["x"].tolist(), np.float64) if len(got) else np.zeros((0, 0))
    return fit_ranking(x, got["y"].to_numpy())


def score(docs: DataFrame, model: Ranking, into: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text in ``into``."""
    docs = docs.drop(into)
    schema = docs.withColumn(into, F.lit(0.0)).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            p = shared.value.score(features(*utf8(b.column("text"))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, into])

    return docs.mapInArrow(run, schema)


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    got = score(docs.select("doc_id", "text"), fit(docs, labels))
    return got.select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
