"""Operator 7: languages of a text as a mixture, by expectation-maximisation.

Training counts byte trigrams of words per language over all training texts,
into tables of fixed size. A text's words have a likelihood under each
language; expectation-maximisation estimates the proportions of the
languages. The set of languages is chosen among the nested sets of the most
probable ones by penalised likelihood (half a log of the word count for each
further language). The prediction is the language of the largest share, its
score that share.

Defined cases: ``und`` with score 0 for null texts, texts without a letter,
and when no language could be learned; equal shares go to the language first
in order; null languages train nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import LOWER, id_crc, row_of, slices, utf8

# fixed size of a language's table of trigrams
BUCKETS = 1 << 16
SMOOTH = 0.5
LETTERS = np.zeros(256, bool)
LETTERS[97:123] = True
LETTERS[128:] = True


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter byte, the starts of the words
    among them, and the n+1 word offsets of the texts."""
    data = LOWER[data]
    letter = LETTERS[data]
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[off] = True
    code = np.where(letter, data, 0x20).astype(np.uint32)
    before = np.full(n, 0x20, np.uint32)
    before[1:] = np.where(first[1:n], 0x20, code[:-1])
    after = np.full(n, 0x20, np.uint32)
    after[:-1] = np.where(first[1:n], 0x20, code[1:])
    at = np.flatnonzero(letter)
    h = (before[at] << np.uint32(16) | code[at] << np.uint32(8) | after[at]) * np.uint32(0x9E3779B1)
    bucket = (h ^ (h >> np.uint32(15))) >> np.uint32(16) if BUCKETS == 1 << 16 else h % BUCKETS
    start = letter.copy()
    start[1:] &= ~letter[:-1] | first[1:n]
    where = np.flatnonzero(start)
    words = np.searchsorted(at, where)
    return bucket.astype(np.int64), words, np.searchsorted(where, off)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probability tables, from every text of
    ``docs`` (columns text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches):
            data, off = utf8(b.column("text"))
            bucket, words, rows = trigrams(data, off)
            langs = b.column("lang").to_pylist()
            ends = np.append(words, len(bucket))[rows]
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            got = np.bincount(np.repeat(number, np.diff(ends)) * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            for x, c in zip(names, got.reshape(len(names), BUCKETS), strict=True):
                total[x] = total.get(x, 0) + c
        for x, c in total.items():
            nz = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(nz), pa.string()), pa.array(nz.astype(np.int32)), pa.array(c[nz])], ["lang", "bucket", "c"])

    known = docs.where("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    counted = known.mapInArrow(run, "lang string, bucket int, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c"))
    got = counted.toPandas()  # at most BUCKETS rows a language
    names = sorted(got["lang"].unique())
    counts = np.zeros((len(names), BUCKETS))
    for k, x in enumerate(names):
        part = got[got["lang"] == x]
        counts[k, part["bucket"].to_numpy()] = part["c"].to_numpy()
    logs = np.log(counts + SMOOTH) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
    return names, logs.astype(np.float32)


def _shares(p: np.ndarray, top: np.ndarray, doc: np.ndarray, rows: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by expectation-maximisation, and the log-likelihood, of texts
    that all have words. p: scaled likelihoods (words, languages)."""
    share = start
    n = np.diff(rows)[:, None]
    for k in range(rounds + 1):
        joint = share[doc] * p
        total = np.maximum(joint.sum(axis=1), 1e-30)
        if k == rounds:
            break
        share = np.add.reduceat(joint / total[:, None], rows[:-1], axis=0) / n
    return share, np.add.reduceat(np.log(total.astype(np.float64)) + top, rows[:-1])


def mixture(data: np.ndarray, off: np.ndarray, logs: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages (texts, languages; zeros for a text
    without words) and the number of words."""
    bucket, words, rows = trigrams(data, off)
    n_lang = len(logs)
    out = np.zeros((len(off) - 1, n_lang))
    n = np.diff(rows)
    full = np.flatnonzero(n)
    if not len(full) or not n_lang:
        return out, n
    like = np.column_stack([np.add.reduceat(t[bucket], words) for t in logs]).astype(np.float32)
    top = like.max(axis=1)
    p = np.exp(np.maximum(like - top[:, None], -60))
    rows = np.append(rows[:-1][full], rows[-1])
    doc = row_of(rows)
    alone = np.add.reduceat(like.astype(np.float64), rows[:-1], axis=0)
    share, _ = _shares(p, top, doc, rows, np.full((len(full), n_lang), 1 / n_lang, np.float32), rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    single = np.argmax(alone, axis=1)
    best = np.zeros((len(full), n_lang))
    best[np.arange(len(full)), single] = 1
    value = alone.max(axis=1)
    for k in range(2, n_lang + 1):
        # texts whose k-th language has no share to speak of cannot gain
        some = np.flatnonzero(share[np.arange(len(full)), order[:, k - 1]] * n[full] > 0.5)
        if not len(some):
            break
        part = np.isin(doc, some) if len(some) < len(full) else slice(None)
        of = np.concatenate([[0], np.cumsum(n[full][some])])
        begin = np.where(rank[some] < k, share[some] + 1e-6, 0).astype(np.float32)
        begin /= begin.sum(axis=1, keepdims=True)
        got, fit = _shares(p[part], top[part], row_of(of), of, begin, rounds)
        fit -= 0.5 * (k - 1) * np.log(n[full][some] + 1)
        win = fit > value[some]
        best[some[win]], value[some[win]] = got[win], fit[win]
    out[full] = best
    return out, n


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def detect(docs: DataFrame, names: list[str], logs: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_shares (all chosen languages)."""
    docs = docs.drop("lang_pred", "score", "lang_shares")
    shares = "map<string,double>"
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast(shares).alias("lang_shares")).schema
    model = docs.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            data, off = utf8(b.column(text))
            share, n = mixture(data, off, model.value)
            best = share.argmax(axis=1) if names else np.zeros(len(n), int)
            plain = np.concatenate([[0], np.cumsum((LOWER[data] >= 97) & (LOWER[data] <= 122))])
            sure = plain[off[1:]] > plain[off[:-1]]
            col = b.column(text)
            ok = [bool(names) and n[i] > 0 and (bool(sure[i]) or has_letter(col[i].as_py())) for i in range(len(n))]
            pred = [names[k] if o else "und" for k, o in zip(best, ok, strict=True)]
            value = np.where(ok, share.max(axis=1) if names else 0.0, 0.0)
            maps = [[(names[k], float(r[k])) for k in np.flatnonzero(r)] if o else [] for r, o in zip(share, ok, strict=True)]
            cols = [pa.array(pred, pa.string()), pa.array(np.clip(value, 0, 1)), pa.array(maps, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, "lang_pred", "score", "lang_shares"])

    return docs.mapInArrow(run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learning from the rows not held out."""
    held = id_crc() % 4 == 2
    names, logs = train(docs.where(~held))
    return detect(docs.select("doc_id", "text"), names, logs).select("doc_id", held.alias("held_out"), "lang_pred", "score")
