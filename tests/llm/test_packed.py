"""Packed integers come back as they were."""

import numpy as np
import pytest

from featuremart.llm.packed import pack, pack_counted, summed, unpack, unpack_counted
from featuremart.llm.pitman_yor import Places, Words
from featuremart.llm.text import ALNUM_WORDS, LOWER, SPACE_WORDS, distinct, lowered, word_spans


def test_round_trips():
    r = np.random.default_rng(1)
    x = np.append(r.integers(0, 1 << 62, 1000) >> r.integers(0, 62, 1000), [0, 127, 128, (1 << 63) - 1])
    assert (unpack(pack(x)) == x).all() and len(unpack(pack(x[:0]))) == 0
    keys, n = np.unique(r.integers(0, 1 << 40, 1000)), r.integers(1, 500, 1000)[: len(x)]
    n = n[: len(keys)]
    back = unpack_counted(*pack_counted(keys, n))
    assert (back[0] == keys).all() and (back[1] == n).all()
    keys, n = summed(np.array([5, 2, 5, 2, 9]), np.array([1, 2, 3, 4, 5]))
    assert keys.tolist() == [2, 5, 9] and n.tolist() == [6, 4, 5]


@pytest.mark.parametrize("size", [1, 500])
def test_buckets_are_ranges_of_pairs(monkeypatch, size):
    from featuremart.llm import pitman_yor

    monkeypatch.setattr(pitman_yor, "PAIRS_IN_BUCKET", 300)
    h = np.arange(100, 100 + size, dtype=np.uint64)
    words = Words(h, np.arange(size, dtype=np.int32), np.sort(np.random.default_rng(2).integers(1, 900, size))[::-1], size, 1)
    ctx, w = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    runs = list(words.buckets((ctx * size + w).ravel()))
    assert [i for _, i, _ in runs] == [0, *(j for _, _, j in runs[:-1])] and runs[-1][2] == size * size
    assert [k for k, _, _ in runs] == sorted({k for k, _, _ in runs})
    assert list(words.buckets(np.zeros(0, np.int64))) == []


def test_equal_counts_are_summed():
    keys, n = summed(np.array([5, 2, 5, 2, 9, 5]), np.full(6, 3))
    assert keys.tolist() == [2, 5, 9] and n.tolist() == [6, 9, 3]


def test_places_of_hashes():
    r = np.random.default_rng(5)
    for size in (0, 1, 2, 3000):
        key = np.unique(r.integers(0, 1 << 64, size, dtype=np.uint64))
        close = np.append(key, key[:9] + np.uint64(1))  # many under the same top bits
        key = np.unique(np.concatenate([close, np.arange(50, dtype=np.uint64), [(1 << 64) - 1]]).astype(np.uint64)) if size else key
        look = np.concatenate([key, key + np.uint64(1), r.integers(0, 1 << 64, 500, dtype=np.uint64)]).astype(np.uint64)
        at, hit = Places(key)(look)
        assert (hit == np.isin(look, key)).all() and (key[at[hit]] == look[hit]).all()


def test_words_are_looked_up_once():
    """A token is looked up once, as itself and as the word before the next."""
    h = np.sort(np.random.default_rng(6).integers(0, 1 << 64, 40, dtype=np.uint64))
    words, seen = Words(h, np.arange(40, dtype=np.int32), np.full(40, 5), 30, 1), []
    words.places = lambda look, find=words.places: (seen.append(len(look)), find(look))[1]
    now = np.concatenate([h[[3, 35, 1]], [np.uint64(7)], h[[2, 2]]])
    pair, packed = words.packed(now)
    assert seen == [7] and packed.tolist() == [False, True, False, False, False, True] and pair[packed].tolist() == [3 * 40 + 35, 2 * 40 + 2]


def test_bytes_are_mapped_as_by_their_tables():
    data = np.random.default_rng(7).integers(0, 256, 5000).astype(np.uint8)
    assert (lowered(data) == LOWER[data]).all() and lowered(data).dtype == np.uint8
    for table in (SPACE_WORDS, ALNUM_WORDS, np.zeros(256, bool), np.ones(256, bool)):
        s, e, _ = word_spans(data, np.array([0, len(data)]), table)
        edges = np.flatnonzero(np.diff(table[data], prepend=False, append=False))
        assert s.tolist() == edges[::2].tolist() and e.tolist() == edges[1::2].tolist()


def test_distinct_hashes(monkeypatch):
    r = np.random.default_rng(8)
    unique, slow = np.unique, []
    monkeypatch.setattr(np, "unique", lambda *x, **k: (slow.append(1), unique(*x, **k))[1])
    # the second has hashes that differ in their lowest bits only
    for h, again in ((r.integers(0, 1 << 64, 300, dtype=np.uint64)[r.integers(0, 300, 2000)], 0), (r.integers(0, 99, 2000, dtype=np.uint64), 1), (np.zeros(0, np.uint64), 1)):
        first, n = distinct(h)
        assert len(slow) == again
        _, want, times = unique(h, return_index=True, return_counts=True)
        assert (first == want).all() and (n == times).all() and len(first) == len(want)
