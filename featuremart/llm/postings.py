"""Operator 4: benchmark decontamination by a stored positional inverted index.

``build_index`` writes, for each run of documents, the sorted terms with their
postings (word positions) to the shared folder. ``match`` reads it for blocks
of benchmark windows of bounded size: a window whose terms all occur starts
from its shortest postings list, intersects the others at their offsets, and
what is left are exact phrase matches (or, with ``slop``, proximity matches).

Defined cases: null and empty texts have no words and cannot be hit; items
without words have no window; repeated items count once by id; a null item
id counts as the empty string; repeated documents are judged row by row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import ALNUM_WORDS, LOWER, row_of, slices, span_hash, stored, utf8, word_spans

WINDOW = 10
# windows compared in one pass over the index (bounds what is broadcast)
BLOCK = 20_000
# free positions between documents of one segment, so that no match crosses
GAP = 64
SEGMENT = 8 << 20


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    s, e, rows = word_spans(data, off, ALNUM_WORDS)
    return span_hash(data, s, e), rows


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment: its documents (id, text hash, word count), terms, and
    postings as sorted positions behind the ends of their lists."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = d.schema["doc_id"].dataType.simpleString()
    schema = f"segment string, doc_ids array<{kind}>, text_hashes array<bigint>, n_words array<int>, terms binary, ends binary, positions binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=SEGMENT):
            h, rows = word_hashes(*utf8(b.column("text")))
            pos = (np.arange(len(h)) + GAP * row_of(rows)).astype(np.int32)
            order = np.argsort(h, kind="stable")
            h = h[order]
            new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            ends = np.append(new[1:], len(h)).astype(np.uint32) if len(h) else np.zeros(0, np.uint32)
            as_list = lambda col: pa.ListArray.from_arrays([0, b.num_rows], col)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    as_list(b.column("doc_id")),
                    as_list(b.column("text_hash")),
                    as_list(pa.array(np.diff(rows).astype(np.int32))),
                    pa.array([h[new].tobytes()], pa.binary()),
                    pa.array([ends.tobytes()], pa.binary()),
                    pa.array([pos[order].tobytes()], pa.binary()),
                ],
                ["segment", "doc_ids", "text_hashes", "n_words", "terms", "ends", "positions"],
            )

    return stored(d.mapInArrow(run, schema), "postings")


@dataclass
class Windows:
    """Distinct windows of one block of items and the items that have each."""

    terms: np.ndarray  # (windows, WINDOW), 0 after the last
    size: np.ndarray
    items: list[list[str]]


def blocks(items: DataFrame, id_col: str = "item_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> Iterator[Windows]:
    """Windows of ``items``, read in order of the id, ``block`` at a time."""
    found: dict[tuple, set[str]] = {}

    def made() -> Windows:
        keys = list(found)
        terms = np.zeros((len(keys), window), np.uint64)
        for i, k in enumerate(keys):
            terms[i, : len(k)] = k
        return Windows(terms, np.array([len(k) for k in keys]), [sorted(found[k]) for k in keys])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    for r in rows.toLocalIterator():
        raw = np.frombuffer((r["t"] or "").encode(), np.uint8)
        h, _ = word_hashes(raw, np.array([0, len(raw)]))
        h = h.tolist()
        for k in range(max(len(h) - window, 0) + 1 if h else 0):
            found.setdefault(tuple(h[k : k + window]), set()).add(r["i"])
            if len(found) >= block:
                yield made()
                found.clear()
    if found:
        yield made()


def intersect(lists: list[np.ndarray], slop: int = 0) -> np.ndarray:
    """Starts at which every list has a position at its offset, within ``slop``;
    from the shortest list on."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[order[0]] - order[0]
    for k in order[1:]:
        if not len(starts):
            break
        at = np.searchsorted(lists[k], starts + (k - slop))
        near = lists[k][np.minimum(at, len(lists[k]) - 1)]
        starts = starts[(at < len(lists[k])) & (near <= starts + (k + slop))]
    return starts


def match(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """One row per indexed document: segment, place, doc_id, text_hash, n_words,
    spans (word ranges of matches, merged) and items (ids with a match)."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"segment string, place int, doc_id {kind}, text_hash long, n_words long, spans array<struct<s:int,e:int>>, items array<string>"
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Windows = shared.value
        vocab, code = np.unique(w.terms, return_inverse=True)
        code = code.reshape(w.terms.shape)
        used = np.arange(w.terms.shape[1]) < w.size[:, None]
        for b in batches:
            for i in range(b.num_rows):
                terms = np.frombuffer(b.column("terms")[i].as_buffer(), np.uint64)
                ends = np.frombuffer(b.column("ends")[i].as_buffer(), np.uint32).astype(np.int64)
                positions = np.frombuffer(b.column("positions")[i].as_buffer(), np.int32)
                ids = b.column("doc_ids")[i].values
                n_words = b.column("n_words")[i].values.to_numpy()
                spans: list[list] = [[] for _ in ids]
                items: list[set] = [set() for _ in ids]
                if len(terms) and len(w.size):
                    base = np.concatenate([[0], np.cumsum(n_words + GAP)])
                    at = np.minimum(np.searchsorted(terms, vocab), len(terms) - 1)
                    there = terms[at] == vocab
                    for k in np.flatnonzero((there[code] | ~used).all(axis=1)).tolist():
                        n = int(w.size[k])
                        lists = [positions[ends[t - 1] if t else 0 : ends[t]] for t in at[code[k, :n]].tolist()]
                        starts = intersect(lists, slop)
                        if len(starts):
                            doc = np.searchsorted(base, starts, "right") - 1
                            local = starts - base[doc]
                            for d, s in zip(doc.tolist(), local.tolist(), strict=True):
                                spans[d].append((s, s + n))
                            for d in set(doc.tolist()):
                                items[d].update(w.items[k])
                merged = [[{"s": s, "e": e} for s, e in merge(x)] for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b.column("segment")[i].as_py()] * len(ids), pa.string()),
                        pa.array(np.arange(len(ids), dtype=np.int32)),
                        ids,
                        b.column("text_hashes")[i].values,
                        pa.array(n_words.astype(np.int64)),
                        pa.array(merged, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["segment", "place", "doc_id", "text_hash", "n_words", "spans", "items"],
                )

    return index.mapInArrow(run, schema)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def matches(docs: DataFrame, items: DataFrame, slop: int = 0, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``match`` over all blocks of ``items``, one row per document row."""
    index = build_index(docs)
    parts = [match(index, w, slop) for w in blocks(items, window=window, block=block)]
    if not parts:
        return match(index, Windows(np.zeros((0, window), np.uint64), np.zeros(0, np.int64), []), slop)
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # ranges of several blocks: sweep over them in order
    ranges = F.array_sort(F.flatten(F.collect_list("spans")))
    out = every.groupBy("segment", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"),
        ranges.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    union = """aggregate(spans, cast(array() as array<struct<s:int,e:int>>), (acc, x) ->
        case when size(acc) > 0 and x.s <= element_at(acc, -1).e
             then concat(slice(acc, 1, size(acc) - 1), array(named_struct('s', element_at(acc, -1).s, 'e', greatest(element_at(acc, -1).e, x.e))))
             else concat(acc, array(x)) end)"""
    return out.withColumn("spans", F.expr(union))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    m = matches(docs, items)
    hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.e - x.s)")
    return m.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that a window of ``items`` occurs in."""
    hit = matches(docs, items).where("size(spans) > 0").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct()
    hit = stored(hit, "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_d"]) & (F.xxhash64(docs["text"]) == hit["_h"]), "left_anti")
