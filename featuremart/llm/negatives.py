"""Operator 11: hard negatives by Strassen products of integer tiles.

Vectors are rounded down to integers and packed into blocks, in tasks, as they
are read. Blocks of anchors meet blocks of candidates in groups of bounded
size; a tile of scores is an exact integer product, computed by Strassen's
recursion on zero-padded int64 tiles. One pass keeps each anchor's best rows
of its own label (the positives) in heaps, a second one keeps, for every
anchor and positive, the best rows of other labels inside the window that the
positive's score opens. Heaps hold a fixed number of rows, so heaps of
different groups merge, and no anchor's candidates are ever gathered.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part, nor do vectors whose integer form has a squared length
of 2^62 or more (their scores might not fit a long); rows meet rows of their
own dimension only, empty vectors score 0 with each other; rows of a repeated
id are separate rows, and "other row" excepts just the row itself; an empty
table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.text import stored

SCALE = 256
CANDIDATES = 4096  # rows of one block, less where their vectors take more than
BYTES = 8 << 20
ANCHORS = 1024  # anchors of one block
GROUP = 8  # candidate blocks that meet an anchor block in one task
LEAF = 32  # tiles with a side up to this are multiplied directly
POSITIVES = 5
NEGATIVES = 10

BLOCK = "dim int, block long, rows int, ids binary, labels binary, vectors binary, places binary"
_KINDS = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
_NAMES = ["dim", "block", "rows", "ids", "labels", "vectors", "places"]


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2^64: seven products of half the
    size instead of eight, odd sides padded by a zero row or column."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return _direct(a, b)
    m2, k2, n2 = -(-m // 2), -(-k // 2), -(-n // 2)
    a = np.pad(a, ((0, 2 * m2 - m), (0, 2 * k2 - k))) if m % 2 or k % 2 else a
    b = np.pad(b, ((0, 2 * k2 - k), (0, 2 * n2 - n))) if k % 2 or n % 2 else b
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    b11, b12, b21, b22 = b[:k2, :n2], b[:k2, n2:], b[k2:, :n2], b[k2:, n2:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m2, 2 * n2), np.int64)
    out[:m2, :n2] = p1 + p4 - p5 + p7
    out[:m2, n2:] = p3 + p5
    out[m2:, :n2] = p2 + p4
    out[m2:, n2:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of a leaf: by doubles where every sum stays below 2^53 and so
    is exact, else in int64."""
    if a.size and b.size:
        top = lambda x: max(int(x.max()), -int(x.min()))
        if top(a) * top(b) * a.shape[1] < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def usable(vectors: DataFrame, shift_every: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label, embedding (integers) of the rows that take part; the label
    of every ``shift_every``-th id is moved on by one modulo ``labels``."""
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    x = x.withColumn("embedding", F.transform("embedding", lambda c: F.floor(c * SCALE)))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    moved = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return x.where(length < 2.0**62).withColumn("label", moved)


def _block(dim: int, name: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((places[:, 1], places[:, 0], ids))
    body = [np.ascontiguousarray(x[order], np.int64).tobytes() for x in (ids, labels, vectors, places)]
    cols = [[dim], [name], [len(ids)], *([x] for x in body)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], _NAMES)


class _Packer:
    """Rows gathered by dimension into blocks of at most ``limit``; a block is
    named by its task and its number there."""

    def __init__(self, limit: int) -> None:
        self.limit, self.made, self.held = limit, 0, {}
        self.part = TaskContext.get().partitionId()

    def name(self) -> int:
        self.made += 1
        return (self.part << 32) + self.made - 1

    def add(self, dim: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        limit = max(1, min(self.limit, BYTES // (8 * max(dim, 1))))
        rest = [np.concatenate(x) for x in zip(self.held.pop(dim), columns, strict=True)] if dim in self.held else list(columns)
        while len(rest[0]) >= limit:
            yield self.block(dim, [x[:limit] for x in rest])
            rest = [x[limit:] for x in rest]
        if len(rest[0]):
            self.held[dim] = rest

    def block(self, dim: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        name = self.name()
        if len(columns) == 3:  # rows met for the first time: their place is this block
            columns = [*columns, np.stack([np.full(len(columns[0]), name), np.arange(len(columns[0]))], axis=1)]
        return _block(dim, name, *columns)

    def end(self) -> Iterator[pa.RecordBatch]:
        for dim in sorted(self.held):
            yield self.block(dim, self.held[dim])
        self.held = {}


def _packed(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(limit)
        for b in batches:
            if not b.num_rows:
                continue
            emb = b.column("embedding")
            at = emb.offsets.to_numpy().astype(np.int64)
            at, size = at - at[0], np.diff(at)
            ids, labels = (b.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
            flat = emb.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                yield from packer.add(dim, ids[rows], labels[rows], flat[at[rows][:, None] + np.arange(dim)])
        yield from packer.end()

    return run


def _unpack(block: dict) -> tuple[np.ndarray, ...]:
    n, dim = block["rows"], block["dim"]
    get = lambda c, *shape: np.frombuffer(block[c], np.int64).reshape(n, *shape)
    return get("ids"), get("labels"), get("vectors", dim), get("places", 2)


def _anchors_of(limit: int, every: int):
    """Blocks of the anchors among the rows of candidate blocks, which keep their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(limit)
        for b in batches:
            for block in b.to_pylist():
                ids, labels, vectors, places = _unpack(block)
                pick = np.flatnonzero(ids % every == 0)
                if len(pick):
                    yield from packer.add(block["dim"], ids[pick], labels[pick], vectors[pick], places[pick])
        yield from packer.end()

    return run


def _best(score: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest open scores of each row, of equal ones
    the first columns (columns are ordered by id)."""
    low = np.where(open_, score, np.iinfo(np.int64).min)
    if low.shape[1] > k:
        least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k][:, None]
        above = open_ & (low > least)
        level = open_ & (low == least)
        open_ = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1)[:, None]))
    return np.nonzero(open_)


class Heaps:
    """For each key the ``k`` best (score, id): larger scores, then smaller ids.
    Heaps of the same key merge by pushing one's rows into the other."""

    def __init__(self, k: int) -> None:
        self.k, self.of = k, {}

    def push(self, key, score: int, vec_id: int) -> None:
        heap = self.of.setdefault(key, [])
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -vec_id))
        elif (score, -vec_id) > heap[0]:
            heapq.heapreplace(heap, (score, -vec_id))


def _same_label(k: int):
    """Heaps of each anchor's best other rows of its own label."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        heaps, id_of = Heaps(k), {}
        candidates = [_unpack(r) for r in right.to_pylist()]
        for block in left.to_pylist():
            ids, labels, vectors, places = _unpack(block)
            id_of |= {tuple(p): i for p, i in zip(places.tolist(), ids.tolist(), strict=True)}
            rows_of = {x: np.flatnonzero(labels == x) for x in np.unique(labels).tolist()}
            for c_ids, c_labels, c_vectors, c_places in candidates:
                for label in np.intersect1d(labels, c_labels).tolist():
                    rows, cols = rows_of[label], np.flatnonzero(c_labels == label)
                    score = strassen(vectors[rows], c_vectors[cols].T)
                    own = (places[rows, None] == c_places[None, cols]).all(axis=2)
                    i, j = _best(score, ~own, k)
                    for a, s, c in zip(rows[i].tolist(), score[i, j].tolist(), c_ids[cols[j]].tolist(), strict=True):
                        heaps.push((int(places[a, 0]), int(places[a, 1])), s, c)
        name = key[1].as_py()
        rows = [(name, *place, id_of[place], -v, s) for place, heap in heaps.of.items() for s, v in heap]
        cols = zip(*rows, strict=True) if rows else [()] * 6
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["ab", "block", "place", "anchor_id", "positive_id", "positive_score"])

    return run


def window(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest n with 30 p <= 100 n <= 90 p, without products that overflow."""
    q, r = np.divmod(score, 10)
    return 3 * q + -(-3 * r // 10), 9 * q + 9 * r // 10


def _other_labels(k: int):
    """Heaps of the best rows of other labels, for each anchor and positive inside
    the window of its score."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        heaps = Heaps(k)
        candidates = [_unpack(r) for r in right.to_pylist()]
        for block in left.to_pylist():
            ids, labels, vectors, places = _unpack(block)
            scores = np.frombuffer(block["scores"], np.int64).reshape(len(ids), -1)
            known = np.frombuffer(block["known"], bool).reshape(scores.shape)
            low, high = window(scores)
            for c_ids, c_labels, c_vectors, _ in candidates:
                score = strassen(vectors, c_vectors.T)
                other = labels[:, None] != c_labels
                for p in range(scores.shape[1]):
                    inside = other & (score >= low[:, p, None]) & (score <= high[:, p, None]) & known[:, p, None]
                    i, j = _best(score, inside, k)
                    for a, s, c in zip(i.tolist(), score[i, j].tolist(), c_ids[j].tolist(), strict=True):
                        heaps.push((int(places[a, 0]), int(places[a, 1]), p), s, c)
        rows = [(*key, -v, s) for key, heap in heaps.of.items() for s, v in heap]
        cols = zip(*rows, strict=True) if rows else [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["block", "place", "nth", "negative_id", "negative_score"])

    return run


def _with_scores(k: int):
    """Anchor blocks with the scores of each anchor's positives: the block's rows
    and its anchors' heaps arrive together."""
    names = [*_NAMES, "scores", "known"]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = {(r["b"], r["place"]): r["scores"] for r in right.to_pylist()}
        out = []
        for block in left.to_pylist():
            places = np.frombuffer(block["places"], np.int64).reshape(-1, 2).tolist()
            scores, known = np.zeros((len(places), k), np.int64), np.zeros((len(places), k), bool)
            for i, p in enumerate(places):
                of = found.get(tuple(p), [])
                scores[i, : len(of)], known[i, : len(of)] = of, True
            out.append({**{n: block[n] for n in _NAMES}, "scores": scores.tobytes(), "known": known.tobytes()})
        kinds = pa.schema(list(zip(names, [*_KINDS, pa.binary(), pa.binary()], strict=True)))
        return pa.Table.from_pylist(out, kinds)

    return run


def _meet(anchors: DataFrame, candidates: DataFrame, groups: int, run, schema: str) -> DataFrame:
    """Every anchor block with every candidate block of its dimension, in groups."""
    names = anchors.select("dim", F.col("block").alias("ab")).distinct()
    right = candidates.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups))).join(names, "dim")
    every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
    left = anchors.withColumn("ab", F.col("block")).withColumn("g", F.explode(every))
    return left.groupBy("dim", "ab", "g").cogroup(right.groupBy("dim", "ab", "g")).applyInArrow(run, schema)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for
    the anchors, the rows whose id ``every`` divides. ``vectors``: vec_id, label,
    embedding as ``usable`` returns them."""
    candidates = stored(vectors.mapInArrow(_packed(CANDIDATES), BLOCK), "negative-blocks")
    few = stored(candidates.mapInArrow(_anchors_of(ANCHORS, every), BLOCK), "anchor-rows")
    n_anchors = few.agg(F.sum("rows")).first()[0] or 0
    merged = few.repartition(max(1, -(-n_anchors // ANCHORS)), "block").mapInArrow(_anchors_of(ANCHORS, every), BLOCK)
    anchors = stored(merged, "anchor-blocks")
    groups = max(1, -(-candidates.count() // GROUP))

    heaps = _meet(anchors, candidates, groups, _same_label(positives), "ab long, block long, place long, anchor_id long, positive_id long, positive_score long")
    # the heaps of all groups, merged: a few rows a group for each anchor
    order = Window.partitionBy("block", "place").orderBy(F.desc("positive_score"), "positive_id")
    best = heaps.withColumn("nth", F.row_number().over(order) - 1).where(F.col("nth") < positives)
    best = stored(best, "positives")

    scored = F.array_sort(F.collect_list(F.struct("nth", "positive_score")))  # at most ``positives`` of them
    sent = best.groupBy("ab", F.col("block").alias("b"), "place").agg(F.transform(scored, lambda s: s["positive_score"]).alias("scores"))
    armed = anchors.groupBy("block").cogroup(sent.groupBy("ab")).applyInArrow(_with_scores(positives), f"{BLOCK}, scores binary, known binary")
    armed = stored(armed, "armed-anchors")

    found = _meet(armed, candidates, groups, _other_labels(negatives), "block long, place long, nth long, negative_id long, negative_score long")
    order = Window.partitionBy("block", "place", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(best, ["block", "place", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
