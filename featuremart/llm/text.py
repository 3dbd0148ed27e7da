"""Vectorised text helpers for Arrow batches: bounded slices, word spans, word hashes.

Everything works on the UTF-8 bytes of a whole batch at once; no Python
string is made per word.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from featuremart.session import shared_dir

SLICE_BYTES = 4 << 20

# byte classes: True where a byte belongs to a word
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False
ALNUM_WORDS = np.ones(256, bool)
ALNUM_WORDS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """``LOWER[data]``."""
    upper = (data - np.uint8(65)) < 26
    return data + (upper.view(np.uint8) << np.uint8(5))


def _in_table(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` for a table of 256 truth values, by its runs of False."""
    edges = np.flatnonzero(np.diff(table, prepend=True, append=True))
    word = np.ones(len(data), bool)
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        word &= (data - np.uint8(low)) >= high - low
    return word


def id_crc(column: str | Column = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def id_crc_py(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())


def ensure_checkpoint(spark: SparkSession) -> str:
    """The shared folder, set as the checkpoint folder where it isn't yet."""
    folder = shared_dir(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table that cuts lineage."""
    return f"{ensure_checkpoint(spark)}/{name}-{os.urandom(6).hex()}"


def stored(df, name: str, files: int | None = None):
    """Write ``df`` once to the shared folder and read it back; ``files`` at most,
    where the caller knows that it is small for its number of partitions."""
    spark = df.sparkSession
    path = scratch(spark, name)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Kept:
    """Stored tables by name, each dropped as soon as nothing reads it any more. The
    shuffle files of a write go with its end instead of the driver's next garbage
    collection: only what was written is read again."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def stored(self, df, name: str):
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            path = self.paths[name] = scratch(self.spark, name)
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Leave an empty table in its place."""
        self.spark.range(0).write.mode("overwrite").parquet(self.paths.pop(name))


def unused(df, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


SAMPLE_STEPS = 1 << 40


def sample_cut(rows: int, limit: int) -> int:
    """Bound on ``pmod(hash, SAMPLE_STEPS)`` that leaves about ``limit`` of ``rows`` rows,
    and rather a few more: what is then ordered and limited to ``limit`` rows does
    not grow with the number of partitions."""
    if rows <= limit:
        return SAMPLE_STEPS
    return min(SAMPLE_STEPS, int((limit + 6 * limit**0.5 + 20) / rows * SAMPLE_STEPS) + 1)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n+1 offsets of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = utf8(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def word_spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n+1 word offsets of the rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = _in_table(data, table)
    first = np.zeros(n + 1, bool)
    first[off] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:n]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, off)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span, read eight at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, 0, (1,))
    length = ends - starts
    # the first eight bytes of all spans, then those of longer ones
    h = mix((length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (lanes[starts] & _MASK[np.minimum(length, 8)])) + np.uint64(0x632BE59BD9B4E019)
    todo = np.flatnonzero(length > 8)
    at, left = starts[todo] + 8, length[todo] - 8
    while len(todo):
        lane = lanes[at] & _MASK[np.minimum(left, 8)]
        h[todo] = mix(h[todo] ^ lane) + np.uint64(0x632BE59BD9B4E019)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of each distinct hash, by hash: places are sorted
    with the top bits of their hashes as one number, unless those bits are shared
    by other hashes."""
    bits = np.uint64(len(h).bit_length())
    both = np.sort((h >> bits << bits) | np.arange(len(h), dtype=np.uint64))
    at = (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    top, ordered = both >> bits, h[at]
    new = top[1:] != top[:-1]
    if (new != (ordered[1:] != ordered[:-1])).any():
        _, first, n = np.unique(h, return_index=True, return_counts=True)
        return first, n
    start = np.flatnonzero(np.append(len(h) > 0, new))[: len(h)]
    return at[start], np.diff(np.append(start, len(h)))


def span_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the spans as an Arrow string array, without a Python loop."""
    length = ends - starts
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    idx = np.repeat(starts - off[:-1], length) + np.arange(off[-1])
    body = data[idx] if len(idx) else np.zeros(0, np.uint8)
    arr = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(body)))
    return arr.cast(pa.string())


def row_of(offsets: np.ndarray) -> np.ndarray:
    """Row number of every element from n+1 offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the elements of each row (0 where a row has none)."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
