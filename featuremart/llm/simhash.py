"""Operator 6: SimHash near-duplicates through pigeonhole blocks.

A fingerprint's 64 bits are cut into ``max_distance + 3`` blocks; two
fingerprints at most ``max_distance`` bits apart agree on three blocks or
more, so they share one of the keys made of three blocks. Equal fingerprints
are one node. A key shared by two fingerprints is verified as it stands; one
shared by more is dealt into tiles of bounded size, and each tile returns a
spanning forest of its verified links, never all pairs. The components of
the forests are the components of all links.

Defined cases: null and empty texts have fingerprint zero; a null doc_id
takes part in linking but is never a component id (null where a component
has no other id); repeated rows are kept and share their component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.components import components
from featuremart.llm.text import LOWER, SPACE_WORDS, slices, stored, unused, utf8, word_spans

WIDTH = 4
MAX_DISTANCE = 4
# fingerprints of one chunk of a large key; a tile holds two chunks
CHUNK = 1024


def shingle_hashes(data: np.ndarray, off: np.ndarray, width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a batch, and the n+1 offsets of the rows."""
    data = LOWER[data]
    s, e, rows = word_spans(data, off, SPACE_WORDS)
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    keep = SPACE_WORDS[data]
    body = np.where(keep, data, 0x20).astype(np.uint8)
    keep[e[e < len(keep)]] = True  # one separator after each word
    gone = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(~keep, out=gone[1:])
    buf = body[keep].tobytes()
    s, e = s - gone[s], e - gone[e]
    n = np.diff(rows)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(rows[:-1] - out[:-1], count) + np.arange(out[-1])
    last = np.minimum(first + width, np.repeat(rows[1:], count)) - 1
    cuts = map(buf.__getitem__, map(slice, s[first].tolist(), e[last].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(seed)), np.uint64, len(first))
    return h, out


def majority(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half of its hashes (0 without hashes)."""
    n = np.diff(rows)
    full = np.flatnonzero(n)
    out = np.zeros(len(n), np.uint64)
    if not len(full):
        return out
    # sums of single bits in byte lanes, in runs of at most 255 hashes
    runs = -(-n[full] // 255)
    at = np.concatenate([[0], np.cumsum(runs)])
    starts = np.repeat(rows[:-1][full], runs) + 255 * (np.arange(at[-1]) - np.repeat(at[:-1], runs))
    ones = np.uint64(0x0101010101010101)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & ones, starts).astype("<u8")
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), at[:-1], axis=0)
        for j in range(8):
            out[full] |= (2 * sums[:, j] > n[full]).astype(np.uint64) << np.uint64(8 * j + k)
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` without the text, with a 64-bit fingerprint (as signed long) in ``into``."""
    keep = [c for c in docs.columns if c not in (text, into)]
    schema = docs.select(*keep).withColumn(into, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            fp = majority(*shingle_hashes(*utf8(b.column(text)), width))
            cols = [b.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp.view(np.int64))], [*keep, into])

    return docs.select(*keep, text).mapInArrow(run, schema)


def block_masks(max_distance: int) -> list[int]:
    """Bit masks of three blocks each, as signed longs."""
    n = max_distance + 3
    edges = [round(64 * k / n) for k in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [x | y | z for x, y, z in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links of one tile: each fingerprint is compared
    with those not reached yet, so a dense group costs little."""
    rest = np.arange(1, len(fp))
    queue, a, b = [0], [], []
    while len(rest):
        if not queue:
            queue.append(int(rest[0]))
            rest = rest[1:]
            continue
        u = queue.pop()
        near = np.bitwise_count(fp[rest] ^ fp[u]) <= max_distance
        if near.any():
            found = rest[near]
            a.append(np.full(len(found), u))
            b.append(found)
            queue += found.tolist()
            rest = rest[~near]
    none = np.zeros(0, np.int64)
    return (fp[np.concatenate(a)], fp[np.concatenate(b)]) if a else (fp[none], fp[none])


def _tile_links(max_distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_key, left_fp = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)

        def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            pairs = [forest(x, max_distance) for x in np.split(fp, cuts) if len(x) > 1]
            a = np.concatenate([p for p, _ in pairs]) if pairs else np.zeros(0, np.uint64)
            b = np.concatenate([q for _, q in pairs]) if pairs else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            key = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("k", "key", "i", "j")])
            key = np.concatenate([left_key, key])
            fp = np.concatenate([left_fp, batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)])
            if not len(fp):
                continue
            same = np.flatnonzero((key != key[-1]).any(axis=1))
            cut = int(same[-1]) + 1 if len(same) else 0  # the last tile may go on
            if cut:
                yield links(key[:cut], fp[:cut])
            left_key, left_fp = key[cut:], fp[cut:]
        if len(left_fp):
            yield links(left_key, left_fp)

    return run


def near_links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): verified links that connect whatever is within ``max_distance``
    bits, from distinct fingerprints in column ``fp``."""
    masks = block_masks(max_distance)
    key = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(masks)]))
    keyed = distinct.select("fp", key.alias("x")).select("fp", "x.k", "x.key")
    shared = keyed.groupBy("k", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = stored(shared.where("n > 1"), "simhash-keys")
    two = shared.where("n = 2").select("a", "b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    more = shared.where("n > 2").select("k", "key", F.ceil(F.col("n") / CHUNK).cast("int").alias("g"))
    dealt = keyed.join(more, ["k", "key"]).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
    other = F.when(F.col("g") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1))
    dealt = dealt.withColumn("o", F.explode(other)).where("g = 1 or o <> c")
    tiles = dealt.select("k", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "fp")
    order = ["k", "key", "i", "j"]
    tiles = tiles.repartition(*order).sortWithinPartitions(*order)
    return two.unionByName(tiles.mapInArrow(_tile_links(max_distance), "a long, b long"))


def classified(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row of ``docs`` (doc_id, text), and
    (fp, component) of every fingerprint; a component is named by one of its
    fingerprints."""
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    fps = stored(fingerprints(d, width, into="fp"), "simhash-fp")
    distinct = stored(fps.select("fp").distinct(), "simhash-distinct")
    nodes = stored(components(near_links(distinct, max_distance)), "simhash-nodes")
    member = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", F.coalesce("component", "fp").alias("component"))
    return fps, stored(member, "simhash-member")


def near_duplicates(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row of ``docs``."""
    fps, member = classified(docs, width, max_distance)
    first = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-first")
    root = first.join(member, "fp").groupBy("component").agg(F.min("low").alias("component_id"))
    classes = stored(member.join(stored(root, "simhash-root"), "component").select("fp", "component_id"), "simhash-class")
    return fps.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = WIDTH, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The row of each component with the smallest doc_id (null ids last), then
    the smallest hash of the text; rows that repeat it are one."""
    fps, member = classified(docs.select("doc_id", "text"), width, max_distance)
    # the smallest row of each fingerprint, then of each component
    keys = unused(docs, "none", "id", "hash")
    row = F.struct(F.isnull("doc_id").alias(keys[0]), F.col("doc_id").alias(keys[1]), F.col("text_hash").alias(keys[2]))
    low = stored(fps.groupBy("fp").agg(F.min(row).alias("row")), "simhash-rows")
    keep = low.join(member, "fp").groupBy("component").agg(F.min("row").alias("row"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    keep = stored(keep.select("row.*").withColumn(keys[1], name(keys[1])), "simhash-keep")
    d = docs.withColumns(dict(zip(keys, (F.isnull("doc_id"), name("doc_id"), F.xxhash64("text")), strict=True)))
    return d.join(keep, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
