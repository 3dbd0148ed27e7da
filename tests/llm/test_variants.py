"""Operator 12 against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.llm import variants as V
from tests.llm.test_operators import CASES, SF, prose

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs, least=7):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return n


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_groups(n):
    words = sorted(w for w, k in n.items() if k >= 2)
    # near words agree after some letter is left out: the same found by another way
    masks = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            masks.setdefault(key, []).append(w)
    near = {w: set() for w in words}
    for group in masks.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w in words:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def groups_of(df):
    return sorted(tuple(r) for r in V.grouped(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(3)


def varied(seed, size, stems):
    """Texts of stems, many of them with an error, some stems far more frequent."""
    r = random.Random(seed)
    letters = "abcdeéßÿÀ×"
    base = ["".join(r.choice(letters) for _ in range(r.randrange(7, 14))) for _ in range(stems)]
    base += [w[: r.randrange(len(w))] + r.choice(letters) + w[r.randrange(len(w)) :] for w in base]
    docs = []
    for i in range(size):
        words = []
        for _ in range(80):
            w = base[min(int(r.expovariate(0.08)), len(base) - 1)]
            if r.random() < 0.15:
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", r.choice(letters), w[k] * 2]) + w[k + 1 :]
            words.append(w.upper() if r.random() < 0.1 else w)
        docs.append((i, " ".join(words) + r.choice(["", "\n", "7", "日"])))
    return docs


def test_words_are_counted_like_plain(spark):
    docs = [*CASES, (50, "Æther-Ätherisch naïveté ÷×÷×÷×÷× abcdefgĀhijklmn ABCDEFG" * 3), (51, "a" * 70000 + " " + "aB" * 40000), (None, "spelling Spelling " * 40)]
    got = {r["word"]: r["n"] for r in V.counted(frame(spark, docs)).collect()}
    assert got == dict(plain_counts(docs))
    many = [(i, "considerable undertaking Ärgernis") for i in range(2000)]  # a share loses a letter
    got = {r["word"]: r["n"] for r in V.counted(frame(spark, many)).collect()}
    assert got == dict(plain_counts(many)) and len(got) > 10


def test_bit_slices_find_exactly_the_words_one_apart():
    r = random.Random(4)
    for size in (7, 8, 11, 70):
        words = sorted({"".join(r.choice("abé") for _ in range(size)) for _ in range(300)})
        index = V.BitSlices(V._letters(words))
        for m in (size - 1, size, size + 1):
            asked = ["".join(r.choice("abéz") for _ in range(m)) for _ in range(100)]
            for w in words[:100]:
                k = r.randrange(size)
                asked.append({-1: w[:k] + w[k + 1 :], 0: w[:k] + r.choice("abé") + w[k + 1 :], 1: w[:k] + "a" + w[k:]}[m - size])
            a, b = index.one_error(V._letters(asked))
            got = set(zip(a.tolist(), b.tolist(), strict=True))
            assert len(got) == len(a) and got == {(i, j) for i, q in enumerate(asked) for j, w in enumerate(words) if one_apart(q, w)}


@pytest.mark.parametrize("tile", [4096, 8])
def test_groups_equal_plain(spark, monkeypatch, tile):
    monkeypatch.setattr(V, "TILE", tile)  # 8: most halves are dealt into tiles
    monkeypatch.setattr(V, "ASKED", 2)
    monkeypatch.setattr(V, "BUCKET", 100)
    docs = varied(1, 60, 150)
    wanted = plain_groups(plain_counts(docs))
    got = groups_of(frame(spark, docs))
    assert got == sorted(wanted) and sum(w[1] is not None for w in wanted) > 20


def test_chains_of_forms_end_at_their_root(spark):
    words = [("aaaaaaab", 2), ("aaaaaabb", 25), ("aaaaabbb", 300), ("aaaabbbb", 4000), ("zzzzzzzz", 2), ("longer" * 2000, 2), ("longer" * 2000 + "x", 30)]
    docs = [(None, " ".join(w for w, n in words for _ in range(n)))]
    h = {w: zlib.crc32(f":{w}".encode()) % 31 for w, _ in words}
    assert all(h.values())
    got = {r[0]: r[1:] for r in groups_of(frame(spark, docs))}
    assert got["aaaaaaab"] == ("aaaaaabb", "aaaabbbb", 2, 1, 25)
    assert got["aaaaabbb"] == ("aaaabbbb", "aaaabbbb", 300, 2, 4000)
    assert got["zzzzzzzz"] == (None, "zzzzzzzz", 2, 0, None)
    assert got["longer" * 2000][:2] == ("longer" * 2000 + "x",) * 2


def test_groups_of_empty_and_wordless_tables(spark):
    assert groups_of(frame(spark, [])) == []
    assert groups_of(frame(spark, [(1, None), (2, ""), (3, "too few, words here")])) == []


def test_groups_of_a_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert groups_of(df) == sorted(plain_groups(plain_counts(docs)))


def test_near_pairs_stay_in_their_task(spark):
    """A third of all words share a half: what leaves a task is a row per word and tile."""
    words = [("common" + "".join(np.random.default_rng(i).choice(list("abcdef"), 4)), 5) for i in range(400)]
    words += [(w, 3) for w in {prose(1, i) + "abcdefg" for i in range(300)} if re.fullmatch("[a-z]+", w)]
    df = spark.createDataFrame(sorted(set(words)), "word string, n long")
    assert V.near_words(df).groupBy("word").count().where(F.col("count") > 1).count() == 0
