"""Operator 13: best-fit packing of token sequences by length patterns.

Documents become ids, are closed by an end id and cut into pieces. Only the
histogram of piece lengths (one row per length, however many documents) comes
to the driver: patterns of a few lengths that fill a sequence are enumerated,
non-negative least squares fits how often each is repeated, the repeats are
rounded down and realised with exact lengths, and what is left is packed best
fit, longest first, on the histogram. The plan says which sequence takes the
k-th piece of a length; every piece learns its k from counts per task, so no
length, however frequent, is gathered anywhere.

Defined cases: a null or empty text is the end id alone; a text of more than
``size`` ids is cut so that only its first piece may be shorter; repeated
doc_ids are separate documents, a null doc_id stays null; an empty table gives
no rows; extra columns are never read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.text import slices, span_strings, stored, utf8

SIZE = 2048
END_ID = 0
UNITS = 128  # steps of length that patterns are made of
PARTS = 4  # documents of a pattern
BLOCK_BYTES = 4 << 20  # text encoded at once
# shares of the fitted repeats that are tried: what isn't repeated is packed best fit
SHARES = (1.0, 0.75, 0.5, 0.25)
WASTE = 8  # a repeated pattern loses less room than a unit divided by this
CACHE_PARTS = 1_000_000  # distinct parts remembered by one Python worker
CHUNK = 4000  # characters of unseen parts per call of the tokenizer


def _space_like(data: np.ndarray) -> np.ndarray:
    """True at every byte of a white-space character, other than ASCII ones included."""
    out = np.zeros(len(data) + 2, bool)
    d = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = d[:-2], d[1:-1], d[2:]
    out[:-2] = (a == 0x20) | ((a >= 0x09) & (a <= 0x0D)) | ((a >= 0x1C) & (a <= 0x1F))
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    general = (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    three = general | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    for at, width in ((two, 2), (three, 3)):
        for k in range(width):
            out[np.flatnonzero(at) + k] = True
    return out[:-2]


def parts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the parts of all rows, and the n+1 part offsets of the rows. A part
    ends before a single space between two other characters: no match of the
    vocabulary's pattern reaches across, so parts are encoded separately."""
    blank = _space_like(data)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 0x20) & ~blank[:-2] & ~blank[2:]
    first, last = off[:-1][np.diff(off) > 0], off[1:][np.diff(off) > 0] - 1
    cut[last] = False  # the next row may begin with any character
    cut[first] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.searchsorted(starts, off)


class PartIds:
    """The ids of parts in one Python worker; each distinct part is encoded once."""

    _made: dict[str, PartIds] = {}

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True  # a byte-level space
        self._clear()

    @classmethod
    def of(cls, model: str) -> PartIds:
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.at = np.zeros(1 << 16, np.int64)  # end of the ids of part k at k + 1

    def _add(self, names: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        n, k = len(self.known), len(names)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + k + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.at[n + 1 : n + k + 1] = self.used + ends
        self.used += len(ids)
        self.known.update(zip(names, range(n, n + k), strict=True))

    def _learn(self, names: list[str]) -> None:
        plain = [p for p in names if p[0] == " " and p.rfind(" ") == 0]
        joined, size, groups = [], 0, []
        for p in plain:
            if not joined or size > CHUNK:
                joined, size = [], 0
                groups.append(joined)
            joined.append(p)
            size += len(p)
        rest = [p for p in names if p[0] != " " or p.rfind(" ") > 0]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) == len(group) and begins[0] == 0:
                self._add(group, ids, np.append(begins[1:], len(ids)))
            else:  # a vocabulary that doesn't open every part by its space
                rest += group
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        lists = [e.ids for e in found]
        flat = np.array([i for x in lists for i in x], np.uint32)
        self._add(rest, flat, np.cumsum([len(x) for x in lists]).astype(np.int64))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the n+1 offsets of the rows in them."""
        starts, row_at = parts(data, off)
        ends = np.append(starts[1:], len(data)).astype(np.int64)
        out, counts = [], np.zeros(len(starts) + 1, np.int64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")))
            if len(self.known) > CACHE_PARTS:
                self._clear()
            coded = span_strings(data, starts[i:j], ends[i:j]).dictionary_encode()
            names = coded.dictionary.to_pylist()
            unseen = [p for p in names if p not in self.known]
            if unseen:
                self._learn(unseen)
            number = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
            a, n = self.at[number], self.at[number + 1] - self.at[number]
            end = np.cumsum(n)
            out.append(self.flat[np.repeat(a - end + n, n) + np.arange(end[-1])])
            counts[i + 1 : j + 1] = n
            i = j
        ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
        return ids, np.cumsum(counts)[row_at]


def default_model() -> str:
    """File of the installed vocabulary (never copied)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


PIECES = "piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, size: int = SIZE, model: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every text, with
    the task that made them (``part``) and their number there among those of
    their length (``nth``). To be stored before use."""
    model = model or default_model()
    d = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PartIds.of(model)
        part = TaskContext.get().partitionId()
        met = np.zeros(size + 1, np.int64)
        for b in slices(batches, "text", BLOCK_BYTES):
            ids, off = coder.encode(*utf8(b.column("text")))
            rows, crc = [], zlib.crc32
            for k in range(b.num_rows):
                own = np.append(ids[off[k] : off[k + 1]], np.uint32(end_id)).astype("<u4")
                at, n = 0, (len(own) - 1) % size + 1
                while at < len(own):
                    rows.append((k, at, n, crc(own[at : at + n].tobytes())))
                    at, n = at + n, size
            row, start, length, sums = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            order = np.argsort(length, kind="stable")
            sorted_lengths = length[order]
            opens = np.flatnonzero(np.diff(sorted_lengths, prepend=-1))
            nth = np.empty(len(rows), np.int64)
            nth[order] = np.arange(len(rows)) - opens[np.searchsorted(opens, np.arange(len(rows)), "right") - 1]
            nth += met[length]
            met += np.bincount(length, minlength=size + 1)
            heads = np.flatnonzero(start == 0)
            number = np.arange(len(rows)) - heads[row]
            cols = [b.column("doc_id").take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(sums), pa.array(np.full(len(rows), part), pa.int32()), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def patterns(filled: np.ndarray, total: int, most: int = PARTS) -> list[tuple[int, ...]]:
    """All ways to make ``total`` of at most ``most`` lengths (in units, longest
    first, only those that ``filled`` holds), and each short length repeated
    as often as it goes in, alone and with one other that fills the rest."""
    have = [u for u in range(total, 0, -1) if filled[u]]
    out: set[tuple[int, ...]] = set()

    def grow(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.add(chosen)
        elif len(chosen) < most:
            for u in have:
                if u <= left and (not chosen or u <= chosen[-1]):
                    if u * (most - len(chosen)) < left:
                        break
                    grow((*chosen, u), left - u)

    grow((), total)
    for u in have:
        out.add((u,) * (total // u))
        for copies in range(most, total // u + 1):
            if 0 < (rest := total - copies * u) <= total and filled[rest]:
                out.add(tuple(sorted((*(u,) * copies, rest), reverse=True)))
    return sorted(out, reverse=True)


def fitted(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |matrix x - target|, by an active set: the column
    whose gradient is steepest enters, columns that would go negative leave."""
    n = matrix.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    enough = 1e-9 * max(1.0, float(np.abs(matrix.T @ target).max(initial=0)))
    for _ in range(3 * matrix.shape[0]):
        slope = matrix.T @ (target - matrix @ x)
        slope[inside] = -np.inf
        if inside.all() or slope.max() <= enough:
            break
        inside[int(slope.argmax())] = True
        while True:
            at = np.flatnonzero(inside)
            best = np.linalg.lstsq(matrix[:, at], target, rcond=None)[0]
            if (best > 1e-12).all():
                x[:] = 0
                x[at] = best
                break
            bad = best <= 1e-12
            now = x[at]
            step = np.min(now[bad] / np.maximum(now[bad] - best[bad], 1e-300))
            x[at] = np.maximum(now + step * (best - now), 0)
            leave = at[bad & (x[at] <= 1e-12)]
            if not len(leave):
                leave = at[[int(best.argmin())]]
            x[leave] = 0
            inside[leave] = False
            if not inside.any():
                break
    return x


def composed(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[tuple[int, int]], int]]:
    """(lengths with their copies, repeats) of all sequences for the pieces of
    ``histogram`` (length to count). The work and the result grow with the
    number of different lengths, not with the pieces."""
    pieces_of = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        pieces_of[length] = n
    unit = -(-size // UNITS)
    total = size // unit
    units = np.minimum(-(-np.arange(size + 1) // unit), total)
    counts = np.bincount(units, weights=pieces_of, minlength=total + 1)
    found = patterns(counts > 0, total)
    if not found:
        return _best_fit(pieces_of, [], size)
    matrix = np.zeros((total, len(found)))
    for k, p in enumerate(found):
        np.add.at(matrix[:, k], np.array(p) - 1, 1.0)
    repeats = fitted(matrix, counts[1:].astype(float))
    best: list[tuple[list[tuple[int, int]], int]] = []
    for share in SHARES:
        left, groups = pieces_of.copy(), []
        for k in np.flatnonzero(repeats):
            groups += _realised(found[k], int(repeats[k] * share + 1e-9), left, unit, size)
        groups = _best_fit(left, groups, size)
        if not best or sum(t for _, t in groups) < sum(t for _, t in best):
            best = groups
    return best


def _realised(pattern: tuple[int, ...], n: int, left: np.ndarray, unit: int, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Up to ``n`` repeats of a pattern with exact lengths, taken off ``left``: the
    longest left of each unit, for the last place the longest that goes in,
    and what still fits beside them. It ends where room would be lost."""
    out = []

    def longest(low: int, high: int, taken: dict[int, int]) -> int:
        for length in range(high, low, -1):
            if left[length] > taken[length]:
                return length
        return 0

    while n > 0:
        taken: dict[int, int] = defaultdict(int)
        room = size
        for place, u in enumerate(pattern):
            length = longest((u - 1) * unit if place + 1 < len(pattern) else 0, min(u * unit, room), taken)
            if not length:
                break
            taken[length] += 1
            room -= length
        while room > unit // WASTE and (length := longest(0, room, taken)):
            m = min(room // length, int(left[length]) - taken[length])
            taken[length] += m
            room -= length * m
        if room > unit // WASTE:
            break
        lengths = {length: m for length, m in taken.items() if m}
        times = min(n, *(int(left[length]) // m for length, m in lengths.items()))
        for length, m in lengths.items():
            left[length] -= m * times
        n -= times
        out.append((sorted(lengths.items(), reverse=True), times))
    return out


def _best_fit(left: np.ndarray, groups: list[tuple[list[tuple[int, int]], int]], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """The pieces still left, longest first, each into the fullest sequence that
    takes it; equal sequences are handled together."""
    by_room: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
    opened = np.zeros(size + 1, bool)

    def put(lengths: list[tuple[int, int]], times: int, room: int) -> None:
        by_room[room].append((lengths, times))
        opened[room] = True

    for lengths, times in groups:
        put(lengths, times, size - sum(length * m for length, m in lengths))
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            rooms = np.flatnonzero(opened[length:size])
            if len(rooms):
                room = int(rooms[0]) + length
                lengths, times = by_room[room].pop()
                opened[room] = bool(by_room[room])
            else:
                lengths, times, room = [], -(-n // (size // length)), size
            each = min(room // length, n)  # copies that a sequence takes
            full = min(times, n // each)
            put([*lengths, (length, each)], full, room - each * length)
            if full < times:
                rest = n - full * each if n - full * each < each else 0
                if rest:
                    put([*lengths, (length, rest)], 1, room - rest * length)
                    n -= rest
                if lengths and times - full - bool(rest):
                    put(lengths, times - full - bool(rest), room)
            n -= full * each
    return [g for room in sorted(by_room) for g in by_room[room]]


def plan(histogram: dict[int, int], size: int = SIZE) -> tuple[np.ndarray, ...]:
    """length, first, copies, sequence, offset: pieces ``first`` and on of a length
    go, ``copies`` at a time, to one sequence after another from ``sequence``,
    the first of them at ``offset``. Ordered by length and first."""
    rows, sequence, met = [], 0, defaultdict(int)
    for lengths, times in composed(histogram, size):
        offset = 0
        for length, copies in lengths:
            rows.append((length, met[length], copies, sequence, offset))
            met[length] += copies * times
            offset += copies * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(np.ascontiguousarray(table[:, k]) for k in range(5))


def packed(docs: DataFrame, size: int = SIZE, model: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = stored(pieces(docs, size, model, end_id), "pieces")
    per_task = stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # at most one row a task in each window
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    length_of, first, copies, sequence, offset = plan(histogram, size)
    opens = np.searchsorted(length_of, np.arange(size + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            length, k = b.column("length").to_numpy(), b.column("k").to_numpy()
            row = np.empty(len(k), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(length[order], prepend=-1)), len(order))
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                at, of = order[a:z], int(length[order[a]])
                row[at] = opens[of] + np.searchsorted(first[opens[of] : opens[of + 1]], k[at], "right") - 1
            turn, copy = np.divmod(k - first[row], copies[row])
            out = [*b.columns[:-1], pa.array(sequence[row] + turn), pa.array(offset[row] + copy * length)]
            yield pa.RecordBatch.from_arrays(out, [*b.schema.names[:-1], "sequence_id", "offset"])

    numbered = cut.join(base, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("k"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
