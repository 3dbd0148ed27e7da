"""Operator 9: nearest neighbours by a block matrix join.

Vectors are packed into blocks with an int8 copy, its scale and the norm of
what rounding lost. Query blocks meet candidate blocks in groups of bounded
size; the product of the int8 tiles and the error bound say which pairs can
still be among a query's nearest, and only these are computed in double
precision. Heaps merge a group's tiles, a ranked window merges the groups.
The result is exact: recall against brute force is 1.

Defined cases: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do null ids; rows of a repeated id all
count as candidates, but never for a query of that id, and queries of one id
share its nearest; a query meets only candidates of its own dimension, ties
go to the smaller id; a sum that overflows is infinite, or, where infinities of
both signs meet, not a number and before all others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.text import stored

CANDIDATES = 4096  # vectors of one candidate block
QUERIES = 16384  # of one query block
TILE = 1024  # queries multiplied at once
GROUP = 4  # candidate blocks that meet a query block in one task
PAIRS = 1 << 16  # pairs recomputed at once
EXACT = 1024  # components whose int8 products a float32 sums exactly: 127 * 127 * 1024 < 2**24

BLOCK_SCHEMA = "dim int, block long, ids binary, vectors binary, codes binary, scale binary, norm binary, lost binary"


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale, the norm of the coded vector, and of the rest."""
    scale = np.abs(v).max(axis=1) / 127.0
    codes = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(v - coded, axis=1)


def _packed(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            order = np.argsort(ids, kind="stable")
            ids, vectors = ids[order], vectors[order]
            codes, scale, norm, lost = quantised(vectors)
            # the smallest id names the block: the same on every attempt
            cols = [[dim], [int(ids[0])], *([x.tobytes()] for x in (ids, vectors, codes, scale, norm, lost))]
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["dim", "block", "ids", "vectors", "codes", "scale", "norm", "lost"])

        for b in batches:
            emb = b.column("embedding")
            size = np.diff(emb.offsets.to_numpy()) if len(emb) else np.zeros(0, int)
            ids = b.column("vec_id").to_numpy().astype(np.int64)
            flat = emb.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(size)])
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                for k in range(0, len(rows), limit):
                    part = rows[k : k + limit]
                    held.setdefault(dim, []).append((ids[part], flat[at[part][:, None] + np.arange(dim)]))
                    if sum(len(i) for i, _ in held[dim]) >= limit:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(~bad & F.exists("embedding", lambda c: c != 0))


def _unpack(table: pa.Table, i: int, dim: int) -> tuple[np.ndarray, ...]:
    get = lambda c, kind: np.frombuffer(table.column(c)[i].as_py(), kind)
    return get("ids", np.int64), get("vectors", np.float64).reshape(-1, dim), get("codes", np.int8).reshape(-1, dim).astype(np.float32), get("scale", float), get("norm", float), get("lost", float)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in order of the components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of int8 codes (held as float32), exact for any dimension."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT):
        out += a[:, d : d + EXACT] @ b[:, d : d + EXACT].T
    return out


def _tiles(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore"):
            return tiles(left, right)

    def tiles(left: pa.Table, right: pa.Table) -> pa.Table:
        # (not a number, score, minus id): the least of the k best comes first
        heaps: dict[int, list[tuple[bool, float, int]]] = {}
        for q in range(left.num_rows):
            dim = left.column("dim")[q].as_py()
            q_ids, q_vec, q_code, q_scale, q_norm, q_lost = _unpack(left, q, dim)
            best = np.full(len(q_ids), -np.inf)  # k-th best so far
            for c in range(right.num_rows):
                if right.column("dim")[c].as_py() != dim:
                    continue
                c_ids, c_vec, c_code, c_scale, c_norm, c_lost = _unpack(right, c, dim)
                for t in range(0, len(q_ids), TILE):
                    z = slice(t, t + TILE)
                    near = _code_products(q_code[z], c_code) * q_scale[z, None] * c_scale
                    error = (q_norm[z, None] + q_lost[z, None]) * c_lost + q_lost[z, None] * c_norm
                    # what summing and scaling in double can round off
                    error += (1e-6 + dim * 2.0**-50) * (q_norm[z, None] * c_norm) + 1e-300
                    own = q_ids[z, None] == c_ids
                    high = near + error
                    low = np.subtract(near, error, out=near)
                    floor = best[z]
                    if len(c_ids) > k:
                        low[own | np.isnan(low)] = -np.inf
                        low.partition(len(c_ids) - k, axis=1)
                        floor = np.maximum(floor, low[:, len(c_ids) - k])
                    del near, low, error
                    # a bound that overflows excludes nothing
                    qi, ci = np.nonzero(~((high < floor[:, None]) | own))
                    for p in range(0, len(qi), PAIRS):
                        a, b = qi[p : p + PAIRS] + t, ci[p : p + PAIRS]
                        for i, s, v in zip(a.tolist(), _product(q_vec[a], c_vec[b]).tolist(), c_ids[b].tolist(), strict=True):
                            heap = heaps.setdefault(int(q_ids[i]), [])
                            one = (False, s, -v) if s == s else (True, 0.0, -v)
                            if len(heap) < k:
                                heapq.heappush(heap, one)
                            elif one > heap[0]:
                                heapq.heapreplace(heap, one)
                    for i in set(qi.tolist()):
                        heap = heaps.get(int(q_ids[i + t]), ())
                        if len(heap) == k and not heap[0][0]:
                            best[i + t] = max(best[i + t], heap[0][1])
        rows = [(q, -v, np.nan if bad else s) for q, heap in heaps.items() for bad, s, v in heap]
        q, v, s = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    return run


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of largest inner
    product for every query, its own id excepted. Both inputs: vec_id, embedding
    as ``usable`` returns them."""
    c = stored(candidates.mapInArrow(_packed(CANDIDATES), BLOCK_SCHEMA), "vector-blocks")
    n_queries = queries.count()
    packed = queries.repartition(max(1, -(-n_queries // QUERIES)), "vec_id").mapInArrow(_packed(QUERIES), BLOCK_SCHEMA)
    q = stored(packed, "query-blocks")
    names = q.select("dim", F.col("block").alias("qb"))
    groups = max(1, -(-c.count() // GROUP))
    right = c.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups))).join(names, "dim")
    left = q.withColumn("qb", F.col("block")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = left.groupBy("dim", "qb", "g").cogroup(right.groupBy("dim", "qb", "g")).applyInArrow(_tiles(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
