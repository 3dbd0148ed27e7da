"""Operator 2: language-model scores from a hierarchical Pitman-Yor model.

Words are customers of restaurants. That of all words has a spelling model as
its base: a word is its bytes and an end mark, and each byte is drawn from the
restaurant of the three bytes before it, whose parents are the restaurants of
two, one and no bytes. A table opened for a word sends its spelling to the
byte restaurants, a table opened there sends its byte to the parent. Above,
every word has a restaurant of the words that follow it; they share the
restaurant of all words as parent. Gibbs sweeps seat all customers anew, given
the other levels; probabilities are means over the sweeps kept. A word that
training lacks is one outcome, as in the base score; it gets what the model
leaves for unseen words, and after it the restaurant of all words holds.

Seating is blocked: all customers of one dish are seated together, given the
tables of the rest from the sweep before, so that a sweep is one pass over
the vocabulary. A sweep draws the customers that open tables directly, one
draw a table instead of one a customer. The restaurant of all words seats
every token, not only the tables of the contexts.

The vocabulary and the pairs of adjacent words are stored tables that grow with
the corpus. Pairs of two of the ``FREQUENT`` most frequent words are numbers,
kept in order in buckets, a byte or two each; texts send theirs to the buckets
in the same form and get one number a text back. Any other word or pair is a
row, joined with the tables. What is shared with all tasks is bounded: the byte
restaurants (32,768 contexts by 256 bytes, contexts being classes of bytes), the
``FREQUENT`` most frequent words with the number of tables after each, and pairs
that make at least 1/``FREQUENT_PAIRS`` of all tokens. The pairs of the most
frequent contexts are seated wherever they are stored, those of any other
context in one task.

A word's probability after a context is the context's own part, for pairs that
training holds, and the context's rest (what it leaves to its parent) times the
word's. So a text's score is the sum over its tokens of log p and log rest, and
over its pairs of what the own part adds.

Defined cases: null and empty texts are one end token; with no training text
every word is unseen, with probability 1; a null doc_id counts as the empty
string in the split; repeated rows are each returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.packed import pack, pack_counted, summed, unpack, unpack_counted
from featuremart.llm.text import SPACE_WORDS, Kept, distinct, id_crc, lowered, mix, row_of, row_sums, slices, span_hash, span_strings, utf8, word_spans

FREQUENT = 1 << 19
SWEEPS = 3
BURN_IN = 1
ORDER = 3  # bytes of context
CLASSES = 32  # of context bytes
CONTEXTS = CLASSES**ORDER
DISCOUNT, STRENGTH = 0.75, 1.0  # of the byte restaurants
WORD_STRENGTH = 10.0
CONTEXT_WORDS = FREQUENT  # contexts whose pairs are seated in many tasks
FREQUENT_PAIRS = 1 << 19
PAIRS_IN_BUCKET = 1 << 21  # tokens
PAIRS_HELD = 1 << 22  # in a task, while pairs are counted
WORD_CONTEXT = 0.8, 50.0  # discount and strength of the restaurants of contexts
LOOKED_UP = 1 << 18  # hashes at once
FEW = 8  # customers seated one by one
BLOCKS_FROM = 200  # weight from which customers are seated in blocks
END = "\n"  # the end token; no word holds it
END_HASH = span_hash(np.array([0x0A], np.uint8), np.array([0]), np.array([1]))[0]

_CLASS = np.array([27 + (b * 7) % 5 for b in range(256)], np.int32)
_CLASS[0x20] = 0
_CLASS[97:123] = np.arange(1, 27)


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cell (context * 256 + byte) of every byte and end mark of the words, and
    the n+1 offsets of the words. The end token is its own mark."""
    data, off = utf8(words)
    n = np.diff(off)
    mark = ~((n == 1) & (data[np.minimum(off[:-1], max(len(data) - 1, 0))] == 0x0A)) if len(data) else np.ones(len(n), bool)
    size = n + mark
    out = np.concatenate([[0], np.cumsum(size)])
    # three blanks before each word, one after it
    padded = np.full(int(out[-1] + ORDER * len(n)), 0x20, np.uint8)
    row = row_of(off)
    padded[np.arange(len(data)) - off[row] + out[row] + ORDER * (row + 1)] = data
    at = np.arange(out[-1]) + ORDER * (row_of(out) + 1)
    kind = _CLASS[padded]
    context = (kind[at - 1] * CLASSES + kind[at - 2]) * CLASSES + kind[at - 3]
    return context.astype(np.int64) * 256 + padded[at], out


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, draw: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray:
    """Tables of each dish after seating its customers one after another, when
    a customer opens a table in proportion to ``weight`` (strength plus discount
    times all tables, times the parent's probability of the dish) and joins one
    in proportion to customers seated less discount times tables. The number of
    customers until the next table is drawn by inversion, one draw a table, or
    where very many open, the tables of the next twentieth of the customers;
    ``draw(dishes, k)`` gives the uniform numbers of round k."""
    tables = np.minimum(customers, 1)
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live))
    k = 0
    while len(live):
        a = np.maximum(weight[live], 1e-300)
        x = seated - discount * tables[live]
        u = draw(live, k)
        # few customers: seat one; more: the chance that the next m all join a
        # table is a ratio of gamma functions, nearly (y / (y + m)) ** a
        y = x + (a - 1) / 2
        with np.errstate(over="ignore", invalid="ignore"):
            joined = np.floor(np.minimum(y * (u ** (-1.0 / a) - 1), 1e18))
        one = x < FEW
        opens = np.where(one, u * (a + x) < a, 1)
        steps = np.where(one, 0, joined) + 1
        # many tables open: a block of customers at once, its tables normal
        many = np.flatnonzero(~one & (a >= BLOCKS_FROM))
        if len(many):
            p = a[many] / (a[many] + x[many])
            m = np.minimum(np.floor(0.05 * (a[many] + x[many])), customers[live[many]] - seated[many])
            z = np.sqrt(-2 * np.log(u[many])) * np.cos(2 * np.pi * draw(live[many], k + (1 << 20)))
            steps[many] = m
            opens[many] = np.clip(np.rint(m * p + np.sqrt(m * p * (1 - p)) * z), 0, m)
        seated = seated + steps
        inside = seated <= customers[live]
        tables[live] += np.where(inside, opens, 0).astype(tables.dtype)
        more = seated < customers[live]
        live, seated = live[more], seated[more]
        k += 1
    return tables


def _draws(names: np.ndarray, seed: int) -> Callable[[np.ndarray, int], np.ndarray]:
    """Uniform numbers that depend on the dish, the round and the seed alone, so
    that every pass and every attempt seats alike."""

    def draw(live: np.ndarray, k: int) -> np.ndarray:
        return (mix(names[live] + np.uint64(seed * 1_000_003 + k)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54

    return draw


@dataclass
class Spelling:
    """Predictive log-probability of each byte; contexts without customers share
    the row of their parent."""

    row: np.ndarray  # of each context
    logp: np.ndarray  # (rows, 256)

    def of(self, cells: np.ndarray) -> np.ndarray:
        return self.logp[self.row[cells >> 8], cells & 255].astype(np.float64)


def byte_model(cells: np.ndarray, counts: np.ndarray, seed: int) -> Spelling:
    """Sample the seating of the byte restaurants bottom-up, and return their
    predictive probabilities."""
    levels = []  # (restaurant * 256 + byte, customers, tables), deepest first
    base = 1.0 / 256
    for level in range(ORDER + 1):
        restaurant = cells // 256
        total = np.bincount(restaurant) if len(cells) else np.zeros(1)
        weight = (STRENGTH + DISCOUNT * total[restaurant]) * base
        tables = seat(counts, weight, DISCOUNT, _draws(mix(cells.astype(np.uint64) + np.uint64(level << 40)), seed))
        levels.append((cells, counts, tables))
        up = (restaurant // CLASSES) * 256 + cells % 256
        cells, inverse = np.unique(up, return_inverse=True)
        counts = np.bincount(inverse, weights=tables).astype(np.int64) if len(up) else tables
    seen = np.unique(levels[0][0] // 256)
    above = p = np.full((1, 256), base)
    for k, (cells, counts, tables) in enumerate(reversed(levels)):
        rooms = CLASSES**k
        c = np.bincount(cells // 256, weights=counts, minlength=rooms)
        t = np.bincount(cells // 256, weights=tables, minlength=rooms)
        parent = np.arange(rooms) // CLASSES if k else np.zeros(1, np.int64)
        above = p
        p = p[parent] * ((STRENGTH + DISCOUNT * t) / (STRENGTH + c))[:, None]
        p[cells // 256, cells % 256] += (counts - DISCOUNT * tables) / (STRENGTH + c)[cells // 256]
    row = np.arange(CONTEXTS) // CLASSES
    row[seen] = len(above) + np.arange(len(seen))
    return Spelling(row.astype(np.int32), np.log(np.concatenate([above, p[seen]])).astype(np.float32))


@dataclass
class Sweep:
    """What a word's probability in one sweep takes besides its own counts."""

    spelling: Spelling
    tables: float  # all tables of the word restaurant before this sweep
    seed: int


def _word_probability(words: pa.Array, c: np.ndarray, sweeps: list[Sweep], total: int, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean probability of the words over ``sweeps``, and their tables in the last."""
    cells, off = spelled(words)
    h = span_hash(*_bounds(words))
    mean, tables = np.zeros(len(c)), np.minimum(c, 1)
    for s in sweeps:
        p = np.exp(row_sums(s.spelling.of(cells), off))
        open_ = WORD_STRENGTH + discount * s.tables
        tables = seat(c, open_ * p, discount, _draws(h, s.seed))
        mean += (np.maximum(c - discount * tables, 0) + open_ * p) / (WORD_STRENGTH + total)
    return mean / max(len(sweeps), 1), tables


def _bounds(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, off = utf8(words)
    return data, off[:-1].copy(), off[1:].copy()


def vocabulary(texts: DataFrame, store: Kept) -> DataFrame:
    """word, c: all tokens of ``texts`` (column text) with their counts, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=8 << 20):
            data, off = utf8(b.column("text"))
            data = lowered(data)
            s, e, _ = word_spans(data, off, SPACE_WORDS)
            first, n = distinct(span_hash(data, s, e))
            yield pa.RecordBatch.from_arrays([span_strings(data, s[first], e[first]), pa.array(n.astype(np.int64))], ["word", "c"])
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([b.num_rows])], ["word", "c"])

    counted = texts.select("text").mapInArrow(run, "word string, c long")
    return store.stored(counted.groupBy("word").agg(F.sum("c").alias("c")), "vocabulary")


@dataclass
class Model:
    vocabulary: DataFrame  # word, c, p, rest (null for the frequent ones)
    pairs: DataFrame  # pair, n, adds (log10 of what the context's own part adds)
    packed: DataFrame  # those of them that are kept by bucket
    rare_pairs: DataFrame  # the others
    shared: Shared
    total: int  # training tokens
    distinct: int
    unseen: float  # probability of a word that is not in the vocabulary
    rare: Column  # whether a word of the vocabulary is not among the frequent ones
    frequent: np.ndarray  # log10 of p times rest of the frequent words, by rank
    frequent_pairs: tuple[np.ndarray, np.ndarray]  # pairs in order, adds
    follows: np.ndarray  # of each frequent context, its own part and its rest


def _tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token (words and one end a text), of the one before it (the
    end token's for the first), and the n+1 offsets of the texts."""
    data, off = utf8(b.column("text"))
    data = lowered(data)
    s, e, rows = word_spans(data, off, SPACE_WORDS)
    off = rows + np.arange(len(rows))
    now = np.full(off[-1], END_HASH, np.uint64)
    now[np.arange(len(s)) + row_of(rows)] = span_hash(data, s, e)
    return now, np.append(END_HASH, now[:-1]), off


def _pair(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(before) ^ now


def _place(key: np.ndarray, look: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each of ``look`` in the ordered ``key``, and whether it is there."""
    if not len(key):
        return np.zeros(len(look), np.int64), np.zeros(len(look), bool)
    at = np.minimum(np.searchsorted(key, look), len(key) - 1)
    return at, key[at] == look


class Places:
    """Finds hashes in an ordered array: the top bits give the first place that can
    hold one, which is within a place or two of it."""

    def __init__(self, key: np.ndarray) -> None:
        self.key = key
        bits = max(len(key).bit_length() - 1, 1)
        self.shift = np.uint64(64 - bits)
        tops = (key >> self.shift).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(tops, minlength=1 << bits))]).astype(np.int32)

    def __call__(self, look: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each of ``look``, and whether it is there."""
        at, hit = np.zeros(len(look), np.int32), np.zeros(len(look), bool)
        for i in range(0, len(look) if len(self.key) else 0, LOOKED_UP):
            at[i : i + LOOKED_UP], hit[i : i + LOOKED_UP] = self._some(look[i : i + LOOKED_UP])
        return at, hit

    def _some(self, look: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = (look >> self.shift).astype(np.int32)
        at, end = self.first[top], self.first[top + 1]
        at = np.minimum(at, len(self.key) - 1)
        hit = self.key[at] == look
        todo = np.flatnonzero(~hit & (at + 1 < end))
        while len(todo):
            at[todo] += 1
            now = self.key[at[todo]] == look[todo]
            hit[todo] = now
            todo = todo[~now]
            todo = todo[at[todo] + 1 < end[todo]]
        return at, hit


@dataclass
class Words:
    """The most frequent words by rank, and where the pairs of two of them are kept.

    The pairs of a context follow each other by the rank of the second word, and
    contexts by their own: a bucket is a range of pairs that holds about
    ``PAIRS_IN_BUCKET`` tokens if words were independent. A context has at most
    ``FREQUENT`` followers, so buckets stay bounded if they are not."""

    key: np.ndarray  # hashes in order
    rank: np.ndarray  # of each
    count: np.ndarray  # of each rank
    contexts: int  # ranks whose pairs are packed
    rare: int  # buckets of the other pairs

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("h", "before", "places")}

    @cached_property
    def h(self) -> np.ndarray:
        """Hash of each rank."""
        out = np.empty_like(self.key)
        out[self.rank] = self.key
        return out

    @cached_property
    def places(self) -> Places:
        return Places(self.key)

    @cached_property
    def before(self) -> np.ndarray:
        """Tokens of lower ranks; then of all."""
        return np.concatenate([[0], np.cumsum(self.count)]).astype(np.float64)

    def ranks(self, look: np.ndarray) -> np.ndarray:
        """Rank, or -1."""
        at, hit = self.places(look)
        return np.where(hit, self.rank[at], -1).astype(np.int64) if len(self.key) else np.full(len(look), -1)

    def packed(self, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the pair of each token (its hash) and the one before it, and
        whether it is packed."""
        ranks = self.ranks(np.append(END_HASH, now))
        ctx, w = ranks[:-1], ranks[1:]
        return ctx * len(self.key) + w, (ctx >= 0) & (ctx < self.contexts) & (w >= 0)

    def parts(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return pair // max(len(self.key), 1), pair % max(len(self.key), 1)

    def name(self, pair: np.ndarray) -> np.ndarray:
        ctx, w = self.parts(pair)
        return _pair(self.h[ctx], self.h[w])

    def buckets(self, pair: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Bucket, first and last + 1 place of the runs of ordered pairs."""
        if not len(pair):
            return
        ctx, w = self.parts(pair)
        of = self.before[ctx] + (self.before[ctx + 1] - self.before[ctx]) * (self.before[w] / self.before[-1])
        bucket = (of / PAIRS_IN_BUCKET).astype(np.int64)
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        yield from zip(bucket[start].tolist(), start.tolist(), np.append(start[1:], len(pair)).tolist(), strict=True)


PACKED = "bucket long, keys binary, counts binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "keys", "counts"])


def _packed_rare(ctx: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return np.stack([ctx, w]).tobytes(), pack(n - 1)


def _unpacked_rare(keys, counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ctx, w = np.frombuffer(keys, np.uint64).reshape(2, -1)
    return ctx, w, unpack(counts) + 1


def _summed_rare(ctx: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    _, first, inverse = np.unique(_pair(ctx, w), return_index=True, return_inverse=True)
    return ctx[first], w[first], np.bincount(inverse, weights=n, minlength=len(first)).astype(np.int64)


def followers(texts: DataFrame, words: Broadcast, store: Kept) -> DataFrame:
    """All adjacent tokens with counts, stored in one row a bucket (bucket, keys,
    counts): numbers of pairs of frequent words, and in buckets below 0 the
    hashes of other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Words = words.value
        pairs, rare = [], []
        size = 0

        def merged() -> tuple[tuple, tuple]:
            return summed(*(np.concatenate(x) for x in zip(*pairs, strict=True))), _summed_rare(*(np.concatenate(x) for x in zip(*rare, strict=True)))

        def rows(pair: tuple, rare: tuple) -> Iterator[pa.RecordBatch]:
            key, n = pair
            out = [(k, *pack_counted(key[i:j], n[i:j])) for k, i, j in known.buckets(key)]
            room = (mix(_pair(*rare[:2])) % np.uint64(known.rare)).astype(np.int64)
            order = np.argsort(room, kind="stable")
            rare, room = [x[order] for x in rare], room[order]
            ends = np.flatnonzero(np.append(room[1:] != room[:-1], True)) + 1 if len(room) else []
            for i, j in zip([0, *ends[:-1]], ends, strict=False):
                out.append((-1 - int(room[i]), *_packed_rare(*(x[i:j] for x in rare))))
            for i in range(0, len(out), 1000):
                yield _packed(out[i : i + 1000])

        for b in slices(batches, limit=8 << 20):
            now, before, _ = _tokens(b)
            key, both = known.packed(now)
            pairs.append(summed(key[both], np.ones(int(both.sum()), np.int64)))
            rare.append(_summed_rare(before[~both], now[~both], np.ones(int((~both).sum()), np.int64)))
            size += len(pairs[-1][0]) + len(rare[-1][0])
            if size > PAIRS_HELD:
                pairs[:], rare[:] = ([x] for x in merged())
                size = len(pairs[0][0]) + len(rare[0][0])
                if size > PAIRS_HELD // 2:
                    yield from rows(pairs[0], rare[0])
                    pairs, rare, size = [], [], 0
        if pairs:
            yield from rows(*merged())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size = None, [], 0

        def together() -> tuple:
            return (_summed_rare if bucket < 0 else summed)(*(np.concatenate(x) for x in zip(*held, strict=True)))

        def row() -> pa.RecordBatch:
            return _packed([(bucket, *(_packed_rare if bucket < 0 else pack_counted)(*together()))])

        for b in batches:
            for i, k in enumerate(b.column("bucket").to_pylist()):
                if k != bucket:
                    if held:
                        yield row()
                    bucket, held, size = k, [], 0
                held.append((_unpacked_rare if k < 0 else unpack_counted)(*(b.column(x)[i].as_buffer() for x in ("keys", "counts"))))
                size += len(held[-1][0])
                if size > PAIRS_HELD:
                    held = [together()]
                    size = min(len(held[0][0]), PAIRS_HELD // 2)
        if held:
            yield row()

    sent = texts.select("text").mapInArrow(run, PACKED)
    return store.stored(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, PACKED), "word-pairs")


def _longs(part: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [part.column(x).to_numpy(zero_copy_only=False) for x in names]


def _seat_pairs(pair: np.ndarray, n: np.ndarray, p: np.ndarray, tables: np.ndarray, seed: int) -> np.ndarray:
    """Tables of each pair, given all ``tables`` of its context in the sweep before."""
    discount, strength = WORD_CONTEXT
    return seat(n, (strength + discount * tables) * p, discount, _draws(mix(pair), seed))


def _adds(own: np.ndarray, rest: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.log10(1 + own / np.maximum(rest * p, 1e-300))


SCORES = "pair long, n long, value double"  # n is null: the pair is a context, the value its rest


def _scores(pair: np.ndarray, n: np.ndarray | None, value: np.ndarray) -> pa.RecordBatch:
    n = pa.nulls(len(pair), pa.int64()) if n is None else pa.array(n)
    return pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), n, pa.array(value)], ["pair", "n", "value"])


def _alone(batches: Iterator[pa.RecordBatch], sweeps: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Seat the pairs (ctx, w, n, p; in order of ctx) of contexts that are whole here."""
    discount, strength = WORD_CONTEXT

    def seated(ctx: np.ndarray, w: np.ndarray, n: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
        ctx, w = ctx.view(np.uint64), w.view(np.uint64)
        start = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1]))
        room = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(ctx))))
        pair = _pair(ctx, w)
        c = np.bincount(room, weights=n)
        t = np.bincount(room).astype(np.float64)
        own, rest = np.zeros(len(n)), np.zeros(len(c))
        for k in range(sweeps):
            tables = _seat_pairs(pair, n, p, t[room], seed + k)
            t = np.bincount(room, weights=tables)
            own += (n - discount * tables) / (strength + c)[room] / sweeps
            rest += (strength + discount * t) / (strength + c) / sweeps
        yield _scores(pair, n, _adds(own, rest[room], p))
        yield _scores(ctx[start], None, rest)

    held: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        now = _longs(b, "ctx", "w", "n", "p")
        held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        last = int(np.searchsorted(held[0], held[0][-1]))  # its pairs may go on
        if last:
            yield from seated(*(x[:last] for x in held))
            held = [x[last:] for x in held]
    if held is not None:
        yield from seated(*held)


@dataclass
class Contexts:
    """What the own parts of the pairs of frequent contexts take: tables of the
    contexts before each sweep and after the last, by rank."""

    totals: list[np.ndarray]
    seed: int

    def rest(self, count: np.ndarray) -> np.ndarray:
        discount, strength = WORD_CONTEXT
        return np.mean([(strength + discount * t) / (strength + count) for t in self.totals[1:]], axis=0)

    def adds(self, name: np.ndarray, room: np.ndarray, n: np.ndarray, p: np.ndarray, count: np.ndarray) -> np.ndarray:
        discount, strength = WORD_CONTEXT
        own = np.zeros(len(n))
        for k, t in enumerate(self.totals[:-1]):
            own += n - discount * _seat_pairs(name, n, p, t[room], self.seed + k)
        return _adds(own / (len(self.totals) - 1) / (strength + count[room]), self.rest(count)[room], p)


def _ordered(key: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order with their texts, sorted as one number where it holds both."""
    bits = int(of.max(initial=0)).bit_length()
    if int(key.max(initial=0)).bit_length() + bits < 63:
        both = np.sort((key << bits) | of)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(key, kind="stable")
    return key[order], of[order]


@dataclass
class Shared:
    """Broadcasts that rate the pairs."""

    words: Broadcast  # of Words
    p: Broadcast  # by rank
    contexts: Broadcast  # of Contexts

    def adds(self, pair: np.ndarray, n: np.ndarray) -> np.ndarray:
        words: Words = self.words.value
        ctx, w = words.parts(pair)
        return self.contexts.value.adds(words.name(pair), ctx, n, self.p.value[w], words.count[: words.contexts])


def context_model(texts: DataFrame, rated: DataFrame, top: tuple[np.ndarray, ...], total: int, sweeps: int, seed: int, store: Kept) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray, Shared]:
    """The packed pairs; pair, n, adds of the others; h, rest of the other contexts;
    own part and rest of the frequent contexts; what rates the packed pairs.
    ``rated``: h, p of the words that are not in ``top``, which holds hashes,
    counts and p, most frequent first."""
    sc = texts.sparkSession.sparkContext
    discount, strength = WORD_CONTEXT
    h, count, p = top
    order = np.argsort(h)
    size = min(CONTEXT_WORDS, len(h))
    rare = 2 * (total - int(count[:size].sum())) // PAIRS_IN_BUCKET + 1
    words = sc.broadcast(Words(h[order], order.astype(np.int32), count, size, rare))
    known = sc.broadcast(p)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ctx, w, n = _unpacked_rare(b.column("keys")[i].as_buffer(), b.column("counts")[i].as_buffer())
                room, at = words.value.ranks(ctx), words.value.ranks(w)
                room = np.where(room < size, room, -1)
                value = pa.array(known.value[at] if len(h) else np.zeros(len(w)), mask=at < 0)
                yield from _parts([pa.RecordBatch.from_arrays([pa.array(ctx.view(np.int64)), pa.array(w.view(np.int64)), pa.array(n), pa.array(room.astype(np.int32)), value], ["ctx", "w", "n", "room", "p"])])

    found = followers(texts, words, store)
    packed = found.where("bucket >= 0")
    other = found.where("bucket < 0").mapInArrow(look, "ctx long, w long, n long, room int, p double")
    joined = other.where("p is null").drop("p").join(rated.select(F.col("h").alias("w"), "p"), "w")
    pairs = store.stored(other.where("p is not null").unionByName(joined), "rare-pairs")
    many = pairs.where("room >= 0")

    def summed_up(before: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables and customers in the packed and the other pairs of the frequent
        contexts, at most CONTEXT_WORDS rows; without ``before``, a table a pair."""
        last = sc.broadcast(before)

        def sums(room: np.ndarray, tables: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            rooms, of = np.unique(room, return_inverse=True)
            cols = [pa.array(rooms.astype(np.int64)), *(pa.array(np.bincount(of, weights=x, minlength=len(rooms)).astype(np.int64)) for x in (tables, n))]
            yield from _parts([pa.RecordBatch.from_arrays(cols, ["room", "t", "n"])])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    pair, n = unpack_counted(b.column("keys")[i].as_buffer(), b.column("counts")[i].as_buffer())
                    ctx, w = words.value.parts(pair)
                    tables = np.ones(len(n)) if last.value is None else _seat_pairs(words.value.name(pair), n, known.value[w], last.value[ctx], seed + k)
                    yield from sums(ctx, tables, n)

        def run_other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ctx, w, n, room, p = _longs(b, "ctx", "w", "n", "room", "p")
                yield from sums(room, np.ones(len(n)) if last.value is None else _seat_pairs(_pair(ctx.view(np.uint64), w.view(np.uint64)), n, p, last.value[room], seed + k), n)

        schema = "room long, t long, n long"
        got = packed.mapInArrow(run, schema).unionByName(many.mapInArrow(run_other, schema)).groupBy("room").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).toPandas()
        t, n = np.zeros(size), np.zeros(size)
        t[got["room"]], n[got["room"]] = got["t"], got["n"]
        last.destroy()
        return t.astype(np.int32) if t.max(initial=0) < 1 << 31 else t, n

    t, n = summed_up(None, 0)
    totals = [t]  # tables of the frequent contexts, sweep by sweep
    for k in range(sweeps):
        totals.append(summed_up(totals[-1], k)[0])
    c = count[:size]
    contexts = Contexts(totals, seed)
    rest = contexts.rest(c)
    own = np.mean([(n - discount * t) / (strength + c) for t in totals[1:]], axis=0)
    shared = Shared(words, known, sc.broadcast(contexts))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ctx, w, n, room, p = _longs(b, "ctx", "w", "n", "room", "p")
            pair = _pair(ctx.view(np.uint64), w.view(np.uint64))
            yield _scores(pair, n, shared.contexts.value.adds(pair, room, n, p, shared.words.value.count[:size]))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _alone(batches, sweeps, seed)

    few = pairs.where("room < 0").select("ctx", "w", "n", "p").repartition("ctx").sortWithinPartitions("ctx")
    done = store.stored(many.mapInArrow(rate, SCORES).unionByName(few.mapInArrow(alone, SCORES)), "pair-scores")
    store.drop("rare-pairs")
    rests = done.where("n is null").select(F.col("pair").alias("h"), F.col("value").alias("rest"))
    return packed, done.where("n is not null").withColumnRenamed("value", "adds"), rests, np.column_stack([own, rest]), shared


def rated_pairs(packed: DataFrame, shared: Shared, least: int = 1) -> DataFrame:
    """pair, n, adds of the packed pairs met ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                pair, n = unpack_counted(b.column("keys")[i].as_buffer(), b.column("counts")[i].as_buffer())
                pair, n = pair[n >= least], n[n >= least]
                yield from _parts([pa.RecordBatch.from_arrays([pa.array(shared.words.value.name(pair).view(np.int64)), pa.array(n), pa.array(shared.adds(pair, n))], ["pair", "n", "adds"])])

    return packed.mapInArrow(run, "pair long, n long, adds double")


def pair_parts(docs: DataFrame, model: Model, often: Broadcast) -> DataFrame:
    """doc_id, text_hash, own: what the packed pairs of a text add, one row for
    each row of ``docs`` (doc_id, text_hash, text). Each slice of texts sends its
    pairs to their buckets and gets one number a text back.

    A slice is named by its rows. Rows must come in the same order when they are
    read again, as those of a file do; else an error is raised."""
    shared = model.shared
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["bucket", "kind", "keys", "counts", "slice", "doc_ids", "text_hashes", "pairs"]
    schema = f"bucket long, kind int, keys binary, counts binary, slice long, doc_ids array<{kind}>, text_hashes array<long>, pairs long"

    def batch(like: pa.RecordBatch, bucket, kind, keys, counts, name, ids=None, hashes=None, pairs=None) -> pa.RecordBatch:
        m = len(bucket)
        one = lambda x, t: pa.nulls(m, pa.list_(t)) if x is None else pa.ListArray.from_arrays([0, len(x)], x)
        cols = [pa.array(bucket, pa.int64()), pa.array([kind] * m, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary()), pa.array(name, pa.int64())]
        return pa.RecordBatch.from_arrays([*cols, one(ids, like), one(hashes, pa.int64()), pa.array(pairs or [None] * m, pa.int64())], names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Words = shared.words.value
        known = Places(often.value[0])
        for b in slices(batches, limit=16 << 20):
            ids, hashes = b.column("doc_id"), b.column("text_hash")
            now, before, off = _tokens(b)
            of = row_of(off)
            key, left = words.packed(now)
            left &= ~known(_pair(before, now))[1]
            key, of = _ordered(key[left], of[left])
            seal = hashlib.blake2b(repr((ids.to_pylist(), hashes.to_pylist())).encode(), digest_size=8).digest()
            name = int.from_bytes(seal, "little", signed=True)
            yield batch(ids.type, [-1 - (name & 0xFFFFF)], 2, [None], [None], [name], ids, hashes, [len(key)])
            sent = [(k, pack(np.diff(key[i:j], prepend=0)), pack(of[i:j])) for k, i, j in words.buckets(key)]
            for i in range(0, len(sent), 1000):
                bucket, keys, rows = zip(*sent[i : i + 1000], strict=True)
                yield batch(ids.type, bucket, 1, keys, rows, [name] * len(bucket))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, pair, adds = None, np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            like = b.schema.field("doc_ids").type.value_type
            kinds, at = b.column("kind").to_pylist(), b.column("bucket").to_pylist()
            for i in range(b.num_rows):
                if kinds[i] == 2:
                    yield b.slice(i, 1)
                    continue
                keys, counts = b.column("keys")[i].as_buffer(), b.column("counts")[i].as_buffer()
                if kinds[i] == 0:
                    pair, n = unpack_counted(keys, counts)
                    bucket, adds = at[i], shared.adds(pair, n)
                    continue
                look, of = np.cumsum(unpack(keys)), unpack(counts)
                own = np.zeros(len(of))
                if at[i] == bucket:
                    to, hit = _place(pair, look)
                    own[hit] = adds[to[hit]]
                # pairs that training lacks add nothing
                total = np.bincount(of, weights=own)
                rows = np.flatnonzero(total)
                yield batch(like, [at[i]], 1, [pack(np.diff(rows, prepend=0))], [total[rows].astype("<f4").tobytes()], [b.column("slice")[i].as_py()], pairs=[len(of)])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, heads, total, pairs, expected = None, [], None, 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            if pairs != expected:
                raise RuntimeError("the texts came in another order when they were read again: store them first")
            # slices of the same rows got their answers together
            for ids, hashes in heads:
                yield pa.RecordBatch.from_arrays([ids, hashes, pa.array(total / len(heads))], ["doc_id", "text_hash", "own"])

        for b in batches:
            kinds, of, n = (b.column(x).to_pylist() for x in ("kind", "slice", "pairs"))
            for i in range(b.num_rows):
                if of[i] != name:
                    if name is not None:
                        yield from done()
                    name, heads, total, pairs, expected = of[i], [], np.zeros(0), 0, 0
                if kinds[i] == 2:
                    heads.append((b.column("doc_ids")[i].values, b.column("text_hashes")[i].values))
                    total, expected = np.zeros(len(heads[0][0])), expected + n[i]
                    continue
                pairs += n[i]
                rows = np.cumsum(unpack(b.column("keys")[i].as_buffer()))
                if not heads:
                    raise RuntimeError("the texts came in another order when they were read again: store them first")
                total[rows] += np.frombuffer(b.column("counts")[i].as_buffer(), "<f4")
        if name is not None:
            yield from done()

    table = model.packed.select("bucket", F.lit(0).alias("kind"), "keys", "counts")
    asked = docs.mapInArrow(send, schema).unionByName(table, allowMissingColumns=True)
    answered = asked.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(answer, schema)
    return answered.repartition("slice").sortWithinPartitions("slice", F.desc("kind")).mapInArrow(close, f"doc_id {kind}, text_hash long, own double")


def _most(df: DataFrame, column: str, rows: int) -> Column:
    """Whether ``column`` is above the lowest step of counts that fits in ``rows``."""
    step = F.floor(F.log2(column) * 8)
    steps = df.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=False)
    fits = steps["step"][steps["count"].cumsum() <= rows]
    return step >= (int(fits.min()) if len(fits) else 1 << 30)


def fit(texts: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN, seed: int = 11) -> Model:
    """Learn from all of ``texts``: one pass to count words, one pass over the
    vocabulary for each sweep, one pass to count pairs, one over those for each sweep."""
    store = Kept(texts.sparkSession)
    vocab = vocabulary(texts, store)
    stats = vocab.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("one"), F.count(F.when(F.col("c") == 2, 1)).alias("two")).first()
    total, distinct = int(stats["n"] or 0), int(stats["v"])
    discount = min(max(stats["one"] / max(stats["one"] + 2 * stats["two"], 1), 0.1), 0.9)
    sc = texts.sparkSession.sparkContext
    kept: list[Sweep] = []
    last: Sweep | None = None
    for k in range(burn_in + sweeps):
        now = sc.broadcast(last)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            cells = np.zeros(CONTEXTS * 256, np.int64)
            tables = 0
            for part in _parts(batches):
                words, c = part.column("word"), part.column("c").to_numpy()
                t = np.ones(len(c), np.int64) if now.value is None else _word_probability(words, c, [now.value], total, discount)[1]
                cell, off = spelled(words)
                cells += np.bincount(cell, minlength=len(cells))
                again = np.repeat(t - 1, np.diff(off))
                np.add.at(cells, cell[again > 0], again[again > 0])
                tables += int(t.sum())
            nz = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(nz, -1)), pa.array(np.append(cells[nz], tables))], ["cell", "n"])

        # at most one row for each of the CONTEXTS * 256 cells
        got = vocab.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
        cell, n = got["cell"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.int64)
        spelling = byte_model(cell[cell >= 0], n[cell >= 0], seed + k)
        last = Sweep(spelling, float(n[cell < 0].sum()), seed + k)
        now.destroy()
        if k >= burn_in:
            kept.append(last)
    shared = sc.broadcast(kept)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            p = _word_probability(part.column("word"), part.column("c").to_numpy(), shared.value, total, discount)[0]
            h = pa.array(span_hash(*_bounds(part.column("word"))).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("word"), h, part.column("c"), pa.array(p)], ["word", "h", "c", "p"])

    rated = store.stored(vocab.mapInArrow(rate, "word string, h long, c long, p double"), "rated-words")
    store.drop("vocabulary")
    shared.destroy()
    unseen = max(1.0 - (rated.agg(F.sum("p")).first()[0] or 0.0), 1e-12)
    often = _most(rated, "c", FREQUENT)
    top = rated.where(often).select("h", "c", "p").toPandas().sort_values(["c", "h"], ascending=[False, True])
    most = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), top["p"].to_numpy(np.float64)
    others = rated.where(~often)
    packed, rare, rests, follows, contexts = context_model(texts, others.select("h", "p"), most, total, sweeps, seed, store)
    rest = np.ones(len(most[0]))
    rest[: len(follows)] = follows[:, 1]
    if len(follows) < len(rest):
        asked = texts.sparkSession.createDataFrame(pd.DataFrame({"h": most[0].view(np.int64), "rank": np.arange(len(rest))}), "h long, rank long")
        got = rests.join(asked, "h").select("rank", "rest").toPandas()
        rest[got["rank"]] = got["rest"]
    frequent = np.log10(most[2]) + np.log10(rest)
    known = others.join(rests, "h").drop("h").unionByName(rated.where(often).drop("h"), allowMissingColumns=True)
    known = store.stored(known, "contexts")
    store.drop("rated-words")
    # pairs of at least this share of the tokens are at most FREQUENT_PAIRS
    least = max(-(-total // FREQUENT_PAIRS), 2)
    top = rated_pairs(packed, contexts, least).unionByName(rare.where(F.col("n") >= least)).toPandas()
    pair = top["pair"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(pair)
    shares = pair[order], top["adds"].to_numpy(np.float64)[order]
    return Model(known, rated_pairs(packed, contexts).unionByName(rare), packed, rare, contexts, total, distinct, unseen, ~often, frequent, shares, follows)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10 probability of the
    whole text), one row per row of ``docs`` (doc_id, text)."""
    share = 0.1 * (model.distinct + 1) + model.total
    shared = docs.sparkSession.sparkContext.broadcast(model.frequent)
    pairs = docs.sparkSession.sparkContext.broadcast(model.frequent_pairs)
    words = model.shared.words
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "text_hash", "word", "n", "n_tokens", "n_known", "base", "own", "rows"]
    schema = f"doc_id {kind}, text_hash long, word string, n int, n_tokens long, n_known long, base double, own double, rows long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        known: Words = words.value
        for b in slices(batches):
            m = b.num_rows
            data, off = utf8(b.column("text"))
            data = lowered(data)
            s, e, rows = word_spans(data, off, SPACE_WORDS)
            # words, then the end token of each text
            look = np.concatenate([span_hash(data, s, e), np.full(m, END_HASH)])
            of = np.concatenate([row_of(rows), np.arange(m)])
            at = known.ranks(look)
            hit = at >= 0
            w, at = of[hit], at[hit]
            base = np.bincount(w, np.log10((known.count[at] + 0.1) / share), m)
            own = np.bincount(w, value[at], m)
            # a blank before the row's own key: no word begins with one
            mark = pa.array([f" {x}" for x in b.column("text_hash").to_pylist()], pa.string())
            cols = [b.column("doc_id"), b.column("text_hash"), mark, pa.nulls(m, pa.int32()), pa.array(np.diff(rows) + 1), pa.array(np.bincount(w, minlength=m)), pa.array(base), pa.array(own), pa.array(np.ones(m, np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names)
            # other words, once for each text, to be joined with the vocabulary
            rare = np.flatnonzero(~hit[: len(s)])
            ends = np.flatnonzero(~hit[len(s) :])
            pair = mix(look[rare]) ^ mix(of[rare].astype(np.uint64) + np.uint64(1))
            first, times = distinct(pair)
            pick = rare[first]
            take = pa.array(np.concatenate([of[pick], ends]))
            text = pa.concat_arrays([span_strings(data, s[pick], e[pick]), pa.array([END] * len(ends), pa.string())])
            times = np.concatenate([times, np.ones(len(ends), np.int64)]).astype(np.int32)
            k = len(text)
            blank = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("text_hash").take(take), text, pa.array(times), *blank], names)

    def run_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, adds = pairs.value
        shared_pairs = Places(key)
        for b in slices(batches):
            m = b.num_rows
            now, before, off = _tokens(b)
            look, of = _pair(before, now), row_of(off)
            at, hit = shared_pairs(look)
            own = np.bincount(of[hit], adds[at[hit]], m) if len(key) else np.zeros(m)
            # one row a text for what is known here, one for each other pair that is not packed
            left = ~hit & ~words.value.packed(now)[1]
            take = pa.array(np.concatenate([np.arange(m), of[left]]))
            pair = np.concatenate([mix(np.arange(m).astype(np.uint64)), look[left]]).view(np.int64)
            value = pa.array(np.concatenate([own, np.zeros(len(pair) - m)]), mask=np.arange(len(pair)) >= m)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("text_hash").take(take), pa.array(pair), value], ["doc_id", "text_hash", "pair", "own"])

    vocab = model.vocabulary.where(model.rare).select(F.col("word").alias("_w"), "c", (F.log10("p") + F.log10(F.coalesce("rest", F.lit(1.0)))).alias("adds"))
    joined = d.mapInArrow(run, schema).join(vocab, F.col("word") == F.col("_w"), "left")
    c = F.coalesce("c", F.lit(0))
    whole = F.col("rows").isNotNull()
    one = joined.select(
        "doc_id", "text_hash", "n_tokens", "rows",
        F.when(whole, F.col("n_known")).when(c > 0, F.col("n")).otherwise(0).cast("long").alias("known"),
        F.when(whole, F.col("base")).otherwise(F.col("n") * F.log10((c + 0.1) / F.lit(share))).alias("base"),
        F.when(whole, F.col("own")).otherwise(F.col("n") * F.coalesce("adds", F.log10(F.lit(model.unseen)))).alias("own"),
    )
    # pairs that training lacks add nothing
    after = d.mapInArrow(run_pairs, f"doc_id {kind}, text_hash long, pair long, own double").join(model.rare_pairs.select("pair", "adds"), "pair", "left")
    after = after.select("doc_id", "text_hash", F.coalesce("own", "adds", F.lit(0.0)).alias("own"))
    one = one.unionByName(after, allowMissingColumns=True).unionByName(pair_parts(d, model, pairs), allowMissingColumns=True)
    per = one.groupBy("doc_id", "text_hash").agg(*[F.sum(x).alias(x) for x in ("n_tokens", "rows", "known", "base", "own")])
    # rows that repeat a text under one id are summed together, and returned each
    per = per.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    mean = lambda x: F.col(x) / F.col("rows")
    return per.select("doc_id", mean("n_tokens").cast("long").alias("n_tokens"), mean("known").cast("long").alias("n_known"), mean("base").alias("base_score"), mean("own").alias("score"))


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity (per token), learning from the rows not held out."""
    held = id_crc() % 10 == 0
    d = docs.select("doc_id", "text")
    model = fit(d.where(~held))
    got = score(d, model)
    return got.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
