"""Operators 11 and 13 against plain versions."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.llm import negatives as N
from featuremart.llm import packing as P
from tests.llm.test_operators import CASES, SF, prose

# ---- operator 11


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 2), (33, 70, 41), (64, 64, 64), (100, 37, 129), (5, 0, 7)])
def test_strassen_equals_the_product(shape):
    m, k, n = shape
    r = np.random.default_rng(m * k + n)
    for top in (300, 1 << 40, 1 << 62):  # doubles at the leaves, long sums, sums that wrap
        a, b = (r.integers(-top, top, s) for s in ((m, k), (k, n)))
        exact = a.astype(object) @ b.astype(object) if k else np.zeros((m, n), object)
        wrapped = np.array([[((int(x) + 2**63) % 2**64) - 2**63 for x in row] for row in exact], dtype=np.int64).reshape(m, n)
        for leaf in (1, 4, 32):
            assert (N.strassen(a, b, leaf) == wrapped).all()


def test_window_is_exact_near_the_largest_scores():
    for p in [*range(-40, 41), 2**62 - 1, 2**62 - 7, -(2**62), 10**18 + 3]:
        low, high = N.window(np.array([p]))
        assert (int(low[0]), int(high[0])) == (-(-3 * p // 10), 9 * p // 10)


def plain_negatives(rows, every=100, k_pos=5, k_neg=10):
    used = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        v = [math.floor(256 * c) for c in vector]
        if sum(c * c for c in v) < 2**62:
            used.append((vec_id, v, (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (a, va, la) in enumerate(used):
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), c, j) for j, (c, v, _) in enumerate(used) if j != i and len(v) == len(va))
        for s, c, _ in [x for x in scores if used[x[2]][2] == la][:k_pos]:
            inside = [x for x in scores if used[x[2]][2] != la and 30 * -s <= 100 * -x[0] <= 90 * -s][:k_neg]
            out += [(a, c, r + 1, d, -s, -t) for r, (t, d, _) in enumerate(inside)]
    return sorted(out)


def negatives_of(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, block int").repartition(3)
    return sorted(tuple(r) for r in N.hard_negatives(N.usable(df)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_hard_negatives_with_ties_repeats_and_bad_rows(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, np.round(r.normal(size=6) * 2).tolist(), int(r.integers(0, 4))) for i in range(420)]
    rows += [(i, rows[200][1], rows[200][2]) for i in range(500, 560)]  # copies of an anchor
    rows += [(700, rows[200][1], rows[200][2])] * 3 + [(700, rows[100][1], 3)]  # a repeated id
    rows += [(800, [1.0, 2.0], 0), (801, [2.0, 2.0], 0), (802, [0.5, 1.0], 1), (900, [], 0), (901, [], 0), (903, [], 1)]
    rows += [(1000, None, 1), (1100, [1.0] * 6, None), (None, [1.0] * 6, 1), (1200, [math.nan] * 6, 1), (1300, [1.0, None], 0)]
    rows += [(1400, [1e30] * 6, 1), (1500, [math.inf] * 6, 1), (1600, [0.0] * 6, 2), (1601, [-0.001] * 6, 2)]
    monkeypatch.setattr(N, "CANDIDATES", 64)
    monkeypatch.setattr(N, "ANCHORS", 2)
    monkeypatch.setattr(N, "GROUP", 2)
    got = negatives_of(spark, rows)
    assert got == plain_negatives(rows) and len(got) > 100


def test_hard_negatives_of_few_or_no_rows(spark):
    assert negatives_of(spark, []) == []
    assert negatives_of(spark, [(100, [1.0], 1)]) == []
    assert negatives_of(spark, [(100, [1.0], 1), (2, [1.0], 1), (3, [0.5], 2)]) == [(100, 2, 1, 3, 65536, 32768)]


# ---- operator 13


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.default_model())
    t.encode_special_tokens = True
    return t


def test_parts_encode_like_whole_texts():
    import pyarrow as pa

    from featuremart.llm.text import utf8

    odd = ["", "a", " a", "a ", "  a b  c", "a\n b c\n\nd e", "é è 　 x y", " ", "\n", " 's it's  'll", "1 2 34 5a \u0085 b", "a \x1c b  c"]
    texts = [t or "" for _, t in CASES] + odd * 2 + [prose(300, 8), "日 本 語 " * 40]
    coder, whole = P.PartIds.of(P.default_model()), tokenizer()
    for _ in range(2):  # unseen, then remembered
        ids, off = coder.encode(*utf8(pa.array(texts)))
        for k, t in enumerate(texts):
            assert ids[off[k] : off[k + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


def check_packing(found, docs, size):
    """Pieces are as the texts cut them, sequences are gapless; the number of sequences."""
    t, by_doc, by_sequence = tokenizer(), defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    wanted = defaultdict(list)
    for doc_id, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        n, at, piece = (len(ids) - 1) % size + 1, 0, 0
        while at < len(ids):
            wanted[doc_id].append((piece, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            piece, at, n = piece + 1, at + n, size
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in wanted.items()}
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence)


@pytest.mark.parametrize("size", [2048, 64, 7])
def test_packing_of_odd_texts(spark, size):
    docs = CASES + [(100 + i, prose(5 + i % 40, i)) for i in range(200)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, part int, length int").repartition(5)
    found = P.packed(df, size).collect()
    n = check_packing(found, docs, size)
    assert n <= math.ceil(sum(r["length"] for r in found) / size * 1.05) + 1


def test_packing_of_a_table_is_nearly_full(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = P.packed(df).collect()
    n = check_packing(found, [(r["doc_id"], r["text"]) for r in df.collect()], 2048)
    assert n <= math.ceil(sum(r["length"] for r in found) / 2048) + 1


def test_packing_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.packed(df).collect() == []


def test_least_squares_of_patterns():
    r = np.random.default_rng(1)
    for _ in range(20):
        a = r.integers(0, 3, (8, 30)).astype(float)
        h = a @ np.maximum(r.normal(size=30), 0) + r.random(8)
        x = P.fitted(a, h)
        slope = a.T @ (h - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 0]).max(initial=0) < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_composition_uses_every_piece_once(seed):
    r = np.random.default_rng(seed)
    lengths = [r.integers(1, 2049, 3000), r.integers(1, 30, 3000), r.integers(500, 1100, 3000), np.full(999, 683)][seed]
    histogram = {int(k): int(n) * 1000 for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    used, n = defaultdict(int), 0
    for parts, times in P.composed(histogram):
        assert sum(k * m for k, m in parts) <= 2048
        n += times
        for k, m in parts:
            used[k] += m * times
    left = np.zeros(2049, np.int64)
    for k, m in histogram.items():
        left[k] = m
    assert used == histogram and n <= 1.02 * sum(t for _, t in P._best_fit(left, [], 2048))
    assert len(P.plan(histogram)[0]) < 20_000  # whatever the number of pieces


def test_counts_of_pieces_grow_with_tasks_not_rows(spark):
    """One hot length: every task numbers its own pieces, a window sees one row a task."""
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(8)
    found = P.packed(df, 16).collect()
    assert len(found) == 20000 and len({(r["sequence_id"], r["offset"]) for r in found}) == 20000
    assert len({r["sequence_id"] for r in found}) == 5000
