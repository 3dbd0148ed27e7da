"""Operator 8: repeated passages by recompression.

Rounds rename the text: runs of a symbol become one symbol, then adjacent
pairs whose symbols fall into a left and a right class become one. A name is a
64-bit hash of what it stands for, so names agree over all documents with no
dictionary to pass round, and equal passages keep equal symbol boundaries in
their interior. How long a boundary survives, as far as the words near it
decide alone, ranks it; every window of 50 words chooses its highest boundary
as anchor. Equal windows choose equal anchors, therefore only windows whose
anchor occurs in several documents can repeat.

Whole copies of a text are told by its hash first (the root symbol of a
grammar): all their words go. Then three passes over the other texts: anchors
shared between documents go into a bit set of fixed size; windows with such an anchor are compared by a 96-bit hash
of their words, which gives the first document of each; what later documents
repeat is removed. Counting and joining are Spark aggregations and joins on
anchors and windows, whose rows of one key are pre-aggregated.

Defined cases: a null text has no words; a null doc_id neither removes nor
loses words; documents of the same id do not remove words from each other;
repeated rows are kept and treated alike; texts under 50 words are kept whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import SPACE_WORDS, mix, row_of, slices, span_hash, stored, unused, utf8, word_spans

WINDOW = 50
CONTEXT = 12  # words on either side that may decide on a boundary
ROUNDS = 3
# bits of the set of shared anchors; a full set only lets more windows through
FILTER_BITS = 1 << 27

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
    for x in out:
        x[0] = 1
        np.cumprod(x, out=x)
    return out


class Ranges:
    """Hashes of word ranges from prefix sums."""

    def __init__(self, h: np.ndarray) -> None:
        power, self.inverse = powers(len(h))
        self.prefix = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * power[:-1], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def recompress(h: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS, context: int = CONTEXT) -> np.ndarray:
    """For each word, how many rounds the boundary before it survives that the
    ``context`` words on either side decide on alone."""
    n = len(h)
    level = np.zeros(n, np.int64)
    if not n:
        return level
    at, name, of = np.arange(n), h, doc  # first word, name and document of each symbol
    # words that decide on a symbol, as seen from its left and its right end
    ll = rl = at
    lh = rh = at + 1
    far = n + context  # beyond the document nothing decides
    sure = np.ones(n, bool)
    for r in range(rounds):
        salt = np.uint64(0x9FB21C651E98DF25 + 2 * r)
        for step in ("runs", "pairs"):
            begin = np.append(True, of[1:] != of[:-1])
            finish = np.append(begin[1:], True)
            low, high = np.minimum(ll, rl), np.maximum(lh, rh)
            left_low = np.where(begin, -far, np.append(0, rl[:-1]))
            left_high = np.where(begin, 0, np.append(0, rh[:-1]))
            right_low = np.where(finish, far, np.append(ll[1:], 0))
            right_high = np.where(finish, 2 * far, np.append(lh[1:], 0))
            if step == "runs":
                joined = ~begin & np.append(False, name[1:] == name[:-1])
            else:
                first = (mix(name + salt) & np.uint64(1)).astype(bool)
                joined = ~begin & np.append(False, first[:-1] & ~first[1:])
            # the boundary before a symbol is decided by what decides on both sides
            sure[at] &= (np.minimum(left_low, ll) >= at - context) & (np.maximum(left_high, lh) <= at + context)
            head = np.flatnonzero(~joined)
            count = np.diff(np.append(head, len(at)))
            last = head + count - 1
            many = count > 1
            second, third = np.minimum(head + 1, len(at) - 1), np.maximum(last - 1, 0)
            # a symbol alone is known with its neighbours
            low_one = np.minimum(np.minimum(left_low, low), right_low)[head]
            high_one = np.maximum(np.maximum(left_high, high), right_high)[head]
            if step == "runs":  # a run is known by its first two symbols, or its last two
                new = mix(name[head] * np.uint64(0xD6E8FEB86659FD93) + salt)
                ll_many = np.minimum(np.minimum(left_low, low)[head], ll[second])
                lh_many = np.maximum(np.maximum(left_high, high)[head], lh[second])
                rl_many = np.minimum(np.minimum(right_low, low)[last], rl[third])
                rh_many = np.maximum(np.maximum(right_high, high)[last], rh[third])
            else:
                new = mix(name[head] * np.uint64(0xA0761D6478BD642F) ^ mix(name[second] + salt))
                ll_many, lh_many = np.minimum(low[head], ll[second]), np.maximum(high[head], lh[second])
                rl_many, rh_many = np.minimum(low[last], rl[third]), np.maximum(high[last], rh[third])
            at, name, of = at[head], np.where(many, new, name[head]), of[head]
            ll, lh = np.where(many, ll_many, low_one), np.where(many, lh_many, high_one)
            rl, rh = np.where(many, rl_many, low_one), np.where(many, rh_many, high_one)
        level[at[sure[at]]] = r + 1
    return level


def anchors(h: np.ndarray, rows: np.ndarray, window: int = WINDOW, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the anchor (word number) of each, and the name of
    that anchor: a hash of the words within ``context`` of it."""
    n = len(h)
    doc = row_of(rows)
    start = np.arange(max(n - window + 1, 0))
    start = start[doc[start] == doc[start + window - 1]] if len(start) else start
    if not len(start):
        return start, start, np.zeros(0, np.uint64)
    level = recompress(h, doc, context=context)
    inside = np.arange(context, n - context + 1)
    inside = inside[inside < n]
    name = np.zeros(n, np.uint64)
    name[inside] = mix(Ranges(h).hash(inside - context, inside + context))
    # rank: level, then name; of equal ones the first place wins
    rank = level.astype(np.uint64) << np.uint64(34) | name >> np.uint64(30)
    place = np.uint64(n - 1) - np.arange(n, dtype=np.uint64)
    best = rank << np.uint64(28) | place if n < 1 << 28 else None
    if best is None:
        raise ValueError("one text holds over 2^28 words")
    width = window - 2 * context + 1
    reach = 1
    while 2 * reach <= width:
        best = np.maximum(best, np.append(best[reach:], best[-1:].repeat(reach)))
        reach *= 2
    a = start + context
    top = np.maximum(best[a], best[a + width - reach])
    chosen = n - 1 - (top & np.uint64((1 << 28) - 1)).astype(np.int64)
    return start, chosen, name[chosen]


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, off = utf8(batch.column("text"))
    s, e, rows = word_spans(data, off, SPACE_WORDS)
    return span_hash(data, s, e), rows


def bit_set(names: DataFrame) -> np.ndarray:
    """Bit set of the column ``name`` (long), of fixed size."""
    bit = F.pmod("name", F.lit(FILTER_BITS))
    words = names.select(F.shiftright(bit, 5).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(name, {FILTER_BITS}) & 31 as int))").alias("bits"))
    got = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()  # FILTER_BITS / 32 rows at most
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[got["word"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return out


def has_bit(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    k = (names & np.uint64(32 * len(bits) - 1)).astype(np.int64)
    return (bits[k >> 5] >> (k & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


KEY = ["doc_id", "text_hash", "text_check"]


def _keyed(docs: DataFrame) -> DataFrame:
    d = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), F.hash("text").alias("text_check"), "text")
    return d.withColumn("name", F.xxhash64(*KEY))


def whole_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text_check of documents whose whole text a smaller id has."""
    keys = _keyed(docs).select(*KEY)
    low = keys.groupBy("text_hash", "text_check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    low = stored(low.where("low <> high").drop("high"), "copy-first")
    return stored(keys.join(low, ["text_hash", "text_check"]).where("doc_id > low").select(*KEY).distinct(), "copies")


class Texts:
    """Documents that are no whole copies. A copy is left out by a bit set inside
    each pass; the few others that share a bit with one are found by a join."""

    def __init__(self, docs: DataFrame) -> None:
        self.keyed = _keyed(docs)
        self.copies = whole_copies(docs)
        bits = bit_set(self.copies.select(F.xxhash64(*KEY).alias("name")))
        self.skip = docs.sparkSession.sparkContext.broadcast(bits)
        skip = self.skip

        def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = has_bit(skip.value, b.column("name").to_numpy().view(np.uint64))
                if hit.any():
                    yield b.filter(pa.array(hit))

        others = self.keyed.mapInArrow(flagged, self.keyed.schema).join(self.copies, KEY, "left_anti")
        self.others = stored(others.select(*self.keyed.columns), "not-copies")

    def each(self, make, schema: str) -> DataFrame:
        """Rows that ``make`` yields for slices of all these documents."""
        skip = self.skip

        def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                keep = ~has_bit(skip.value, b.column("name").to_numpy().view(np.uint64))
                if keep.any():
                    yield make(b if keep.all() else b.filter(pa.array(keep)))

        def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield make(b)

        return self.keyed.mapInArrow(most, schema).unionByName(self.others.mapInArrow(rest, schema))


def shared_anchors(texts: Texts, window: int = WINDOW) -> np.ndarray:
    """Bit set of the names of anchors that occur in documents of several ids."""
    kind = texts.keyed.schema["doc_id"].dataType.simpleString()

    def make(b: pa.RecordBatch) -> pa.RecordBatch:
        h, rows = _words(b)
        _, chosen, name = anchors(h, rows, window)
        chosen, k = np.unique(chosen, return_index=True)
        ids = b.column("doc_id").take(pa.array(row_of(rows)[chosen]))
        return pa.RecordBatch.from_arrays([pa.array(name[k].view(np.int64)), ids], ["name", "doc_id"])

    found = texts.each(make, f"name long, doc_id {kind}")
    return bit_set(found.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b"))


def candidate_windows(texts: Texts, shared: np.ndarray, window: int = WINDOW) -> DataFrame:
    """hash, check, doc_id, text_hash, start of every window with a shared anchor."""
    kind = texts.keyed.schema["doc_id"].dataType.simpleString()
    bits = texts.keyed.sparkSession.sparkContext.broadcast(shared)

    def make(b: pa.RecordBatch) -> pa.RecordBatch:
        h, rows = _words(b)
        start, _, name = anchors(h, rows, window)
        start = start[has_bit(bits.value, name)]
        one = Ranges(h).hash(start, start + window)
        two = Ranges(mix(h ^ np.uint64(0x5851F42D4C957F2D))).hash(start, start + window)
        row = row_of(rows)[start]
        pick = pa.array(row)
        local = (start - rows[row]).astype(np.int32)
        cols = [pa.array(mix(one).view(np.int64)), pa.array((mix(two) >> np.uint64(32)).astype(np.uint32).view(np.int32))]
        cols += [b.column("doc_id").take(pick), b.column("text_hash").take(pick), pa.array(local)]
        return pa.RecordBatch.from_arrays(cols, ["hash", "check", "doc_id", "text_hash", "start"])

    return texts.each(make, f"hash long, check int, doc_id {kind}, text_hash long, start int")


def repeated_starts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, starts: the windows that also start in a smaller doc_id;
    null for a whole copy, all of whose windows do."""
    texts = Texts(docs)
    windows = candidate_windows(texts, shared_anchors(texts, window), window)
    first = windows.groupBy("hash", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    first = stored(first.where("low <> high").select("hash", "check", "low"), "first-windows")
    later = windows.join(first, ["hash", "check"]).where("doc_id > low")
    some = later.groupBy("doc_id", "text_hash").agg(F.collect_list("start").alias("starts"))
    whole = texts.copies.select("doc_id", "text_hash", F.lit(None).cast("array<int>").alias("starts"))
    return some.unionByName(whole).withColumn("whole", F.col("starts").isNull())


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with kept_text (kept words joined by a space), n_words, n_removed."""
    docs = docs.drop("kept_text", "n_words", "n_removed")
    where, whole = unused(docs, "starts", "whole")
    found = repeated_starts(docs.select("doc_id", "text"), window).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("starts").alias(where), F.col("whole").alias(whole)
    )
    joined = docs.join(found, (docs["doc_id"] == found["_doc"]) & (F.xxhash64(docs["text"]) == found["_hash"]), "left")
    joined = joined.select(*[docs[c] for c in docs.columns], found[where], F.coalesce(found[whole], F.lit(False)).alias(whole))
    schema = docs.select("*", F.lit("").alias("kept_text"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed")).schema
    keep = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = utf8(b.column("text"))
            s, e, rows = word_spans(data, off, SPACE_WORDS)
            starts = b.column(where)
            flat = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
            size = np.array([len(x) if x.is_valid else 0 for x in starts], np.int64)
            cover = np.zeros(len(s) + 1, np.int64)
            begin = flat + np.repeat(rows[:-1], size)
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + window, -1)
            kept = np.cumsum(cover)[:-1] == 0
            copy = b.column(whole).to_numpy(zero_copy_only=False) & (np.diff(rows) >= window)
            kept &= ~np.repeat(copy, np.diff(rows))
            raw, text = data.tobytes(), []
            for i in range(b.num_rows):
                k = np.flatnonzero(kept[rows[i] : rows[i + 1]]) + rows[i]
                text.append(b" ".join([raw[x:y] for x, y in zip(s[k].tolist(), e[k].tolist(), strict=True)]).decode())
            total = np.concatenate([[0], np.cumsum(~kept)])
            cols = [pa.array(text, pa.string()), pa.array(np.diff(rows)), pa.array(total[rows[1:]] - total[rows[:-1]])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols], [*keep, "kept_text", "n_words", "n_removed"])

    return joined.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    out = without_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
