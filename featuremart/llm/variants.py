"""Operator 12: spelling variants by a bit-sliced position index.

Words are counted over all texts. Two words that differ by one letter agree in
their first or their last half, so each word is filed under both halves and
looked up under the halves that a word of its own length, one less or one more
would have. Where the two meet, the filed words of a length are held as one
bitset per position and letter; a query runs through its letters once, and the
sets of filed words matched so far without an error and with one error move on
together by a few bit operations for all filed words at once. A pair that
agrees in both halves counts where the first halves meet. Pairs never leave
the task: it returns each word's number of near words and the best of them.

Halves that more words share than a tile holds are dealt into tiles on both
sides, each pair of tiles meeting once.

Defined cases: a null or empty text has no words; a null doc_id counts as the
empty text in the hash; copies of a row count each; words of any length are
compared; an empty table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import LOWER, row_of, slices, span_strings, stored, utf8

LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10  # a form occurs at least so many times as often as the word
DROP_EVERY = 31
TILE = 4096  # filed words of one half that one task compares
ASKED = 4  # times as many words looked up there
BUCKET = 16384  # filed words of a group of halves
INDEX_BYTES = 16 << 20  # bitsets of one block of filed words
WORK_BYTES = 1 << 20  # sets of the words looked up at once
LONG = 4096  # letters from which blocks are smaller than 64 words

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CRC = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)  # of a byte on a zero register


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every run of ASCII letters and U+00C0..U+00FF (in
    UTF-8 the byte C3 and one more), and the row of each."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    lead = data == 0xC3
    word = _LETTER[data] | lead
    word[1:] |= lead[:-1]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | first[1 : len(data)]
    ends[:-1] &= ~word[1:] | first[1 : len(data)]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, row_of(np.searchsorted(s, off))


def crc_after(before: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of a text whose crc32 is ``before``, followed by the bytes of each span."""
    c = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    todo, at = np.arange(len(starts)), starts.copy()
    while len(todo):
        if len(todo) < 16:  # the longest: byte by byte is left to zlib
            for k in todo.tolist():
                c[k] = zlib.crc32(data[at[k == todo][0] : ends[k]].tobytes(), int(c[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        now = c[todo]
        c[todo] = _CRC[(now ^ data[at]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
        at += 1
        more = at < ends[todo]
        todo, at = todo[more], at[more]
    return c ^ np.uint32(0xFFFFFFFF)


def counted(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """word, n: how often each word of at least ``least`` code points occurs. A run
    whose hash with its doc_id is divisible by 31 loses one code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = utf8(b.column("text"))
            s, e, row = runs(data, off)
            lead = np.concatenate([[0], np.cumsum(data == 0xC3)])
            size = (e - s) - (lead[e] - lead[s])
            keep = size >= least
            s, e, row, size = s[keep], e[keep], row[keep], size[keep]
            low = LOWER[data]
            heads = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in b.column("doc_id").to_pylist()], np.uint32)
            h = crc_after(heads[row], low, s, e)
            drop = h % np.uint32(DROP_EVERY) == 0
            shorter = []
            for k in np.flatnonzero(drop & (size > least)).tolist():
                text = low[s[k] : e[k]].tobytes().decode()
                at = int(h[k]) % len(text)
                shorter.append(text[:at] + text[at + 1 :])
            words = pa.concat_arrays([span_strings(low, s[~drop], e[~drop]), pa.array(shorter, pa.string())])
            tally = pc.value_counts(words)
            if len(tally):
                yield pa.RecordBatch.from_arrays([tally.field("values"), tally.field("counts")], ["word", "n"])

    per_slice = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return per_slice.groupBy("word").agg(F.sum("n").alias("n"))


def _half(side: int, size: Column) -> Column:
    """First (0) or last (1) half of ``word`` as words of ``size`` letters file it."""
    n = F.floor((size - 1) / 2).cast("int")
    return F.substring("word", F.lit(1), n) if side == 0 else F.right(F.col("word"), n)


def _filed(words: DataFrame) -> DataFrame:
    size = F.length("word")
    rows = [F.struct(F.lit(k).alias("side"), size.alias("size"), F.xxhash64(F.lit(k), size, _half(k, size)).alias("key")) for k in (0, 1)]
    return words.select("word", "n", F.inline(F.array(*rows)))


def _asked(words: DataFrame) -> DataFrame:
    rows = []
    for change in (-1, 0, 1):
        size = F.length("word") + change
        rows += [F.struct(F.lit(k).alias("side"), size.alias("size"), F.xxhash64(F.lit(k), size, _half(k, size)).alias("key")) for k in (0, 1)]
    return words.select("word", F.inline(F.array(*rows))).where(F.col("size") >= LEAST_LETTERS)


class BitSlices:
    """Words of one length as a bitset per position and letter."""

    def __init__(self, letters: np.ndarray) -> None:
        n, self.size = letters.shape
        self.code = np.full(256, 0)  # 0: a letter that no word has
        present = np.unique(letters)
        self.code[present] = np.arange(1, len(present) + 1)
        pad = 64 if self.size <= LONG else 8
        width = -(-n // pad) * pad // 8
        kind = np.uint64 if width % 8 == 0 else np.uint8
        bits = np.zeros((self.size, len(present) + 1, width), np.uint8)
        for i in range(self.size):
            packed = np.packbits(letters[:, i] == present[:, None], axis=1, bitorder="little")
            bits[i, 1:, : packed.shape[1]] = packed
        self.bits = bits.view(kind)
        all_ = np.zeros(width, np.uint8)
        filled = np.packbits(np.ones(n, bool), bitorder="little")
        all_[: len(filled)] = filled
        self.all = all_.view(kind)
        self.n = n

    def one_error(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``asked`` (one length, letters as bytes) and numbers of the words
        that differ from them by exactly one inserted, deleted or replaced letter."""
        q = self.code[asked]
        m, at = asked.shape[1], self.bits
        zero = np.repeat(self.all[None, :], len(q), axis=0)
        one = np.zeros_like(zero)
        for i in range(m):
            if m == self.size:  # a replaced letter: both sets stay at the same place
                here = at[i, q[:, i]]
                one = (one & here) | (zero & ~here)
                zero &= here
            elif m < self.size:  # the word has a letter more: the set with an error is one place ahead
                one = (one | zero) & at[i + 1, q[:, i]]
                zero &= at[i, q[:, i]]
            else:  # it has one less: that set is one place behind
                one = (one & at[i - 1, q[:, i]]) | zero if i else zero.copy()
                zero = zero & at[i, q[:, i]] if i < self.size else np.zeros_like(zero)
            if i % 64 == 63 and not one.any() and not zero.any():
                break
        if m < self.size:
            one = one | zero
        some = np.flatnonzero(one.any(axis=1))
        hits = np.unpackbits(one[some].view(np.uint8), axis=1, bitorder="little")[:, : self.n]
        r, w = np.nonzero(hits)
        return some[r], w


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _compared(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """word, n_near, rest (minus the count of the best near word), form: for the
    words looked up in one bucket, from what is filed there."""
    out: list[pa.Table] = []
    filed: dict[tuple, list] = {}
    for word, n, side in zip(*(left.column(c).to_pylist() for c in ("word", "n", "side")), strict=True):
        filed.setdefault((side, len(word)), []).append((word, n))
    asked: dict[tuple, list] = {}
    for word, side, size in zip(*(right.column(c).to_pylist() for c in ("q_word", "q_side", "q_size")), strict=True):
        if (side, size) in filed:
            asked.setdefault((side, size, len(word)), []).append(word)
    for (side, size), rows in sorted(filed.items()):
        rows.sort()
        half = (size - 1) // 2
        cut = slice(0, half) if side == 0 else slice(size - half, None)
        halves = {w[cut] for w, _ in rows}
        # halves meet, of those looked up, only what some filed word shares
        mine = {}
        for m in (size - 1, size, size + 1):
            tail = slice(0, half) if side == 0 else slice(m - half, None)
            found = sorted(w for w in asked.get((side, size, m), ()) if w[tail] in halves)
            if found:
                mine[m] = found
        if not mine:
            continue
        step = 64 if size <= LONG else 8
        step *= max(1, INDEX_BYTES // (size * 64 * (step // 8)))
        for k in range(0, len(rows), step):
            block = rows[k : k + step]
            letters = _letters([w for w, _ in block])
            index, counts = BitSlices(letters), np.array([n for _, n in block])
            for m, words in mine.items():
                rows_at_once = max(1, WORK_BYTES // index.all.nbytes)
                for j in range(0, len(words), rows_at_once):
                    part = words[j : j + rows_at_once]
                    q = _letters(part)
                    a, b = index.one_error(q)
                    first = (q[a, :half] == letters[b, :half]).all(axis=1)
                    last = (q[a, m - half :] == letters[b, size - half :]).all(axis=1)
                    own = first if side == 0 else last & ~first
                    a, b = a[own], b[own]
                    if not len(a):
                        continue
                    order = np.lexsort((b, -counts[b], a))  # words of a block are in order
                    a, b = a[order], b[order]
                    heads = np.flatnonzero(np.diff(a, prepend=-1))
                    out.append(pa.table({
                        "word": pa.array([part[i] for i in a[heads].tolist()], pa.string()),
                        "n_near": pa.array(np.diff(np.append(heads, len(a)))),
                        "rest": pa.array(-counts[b[heads]]),
                        "form": pa.array([block[i][0] for i in b[heads].tolist()], pa.string()),
                    }))
    kinds = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("rest", pa.int64()), ("form", pa.string())])
    return pa.concat_tables([t.cast(kinds) for t in out]) if out else kinds.empty_table()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, rest, form: for every word of ``words`` (word, n; distinct) that
    has near words their number, minus the largest n among them and the first
    word of that n."""
    filed, asked = _filed(words), _asked(words)
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("f")).join(asked.groupBy("key").agg(F.count(F.lit(1)).alias("a")), "key")
    tiles = sizes.select("key", F.ceil(F.col("f") / TILE).alias("ft"), F.ceil(F.col("a") / (TILE * ASKED)).alias("at"))
    hot = stored(tiles.where((F.col("ft") > 1) | (F.col("at") > 1)), "hot-halves")
    buckets = max(1, -(-2 * words.count() // BUCKET))
    # one more hash than the rows of a tile share, so that tiles are even
    deal = F.xxhash64(F.lit("tile"), "word")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(hot, "key", "left")
        mine = F.pmod(deal, F.coalesce(F.col(own), F.lit(1)))
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), F.lit(1)) - 1))
        rows = rows.withColumn("mine", mine).withColumn("each", each)
        tile = ("mine", "each") if own == "ft" else ("each", "mine")
        return rows.withColumn("bucket", F.pmod(F.xxhash64("key", *tile), F.lit(buckets)))

    left = dealt(filed, "ft", "at").select("bucket", "word", "n", "side")
    # other names: both sides come from the same table
    right = dealt(asked, "at", "ft").select(*[F.col(c).alias(f"q_{c}") for c in ("bucket", "word", "side", "size")])
    found = left.groupBy("bucket").cogroup(right.groupBy("q_bucket")).applyInArrow(_compared, "word string, n_near long, rest long, form string")
    best = F.min(F.struct("rest", "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.rest", "b.form")


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = stored(counted(docs).where(F.col("n") >= LEAST_COUNT), "spelling-words")
    near = near_words(words)
    is_form = -F.col("rest") >= TIMES * F.col("n")
    with_form = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, -F.col("rest")).alias("form_n"),
    )
    with_form = stored(with_form, "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    # n grows ten times a step, so a chain of forms has so many steps at most
    steps = max(1, math.floor(math.log10(max(most, 10))))
    roots = with_form.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):  # each round doubles the steps taken
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    out = with_form.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
