"""Operator 10: byte-level BPE encoding and decoding.

Each Arrow batch is split by the vocabulary's pattern, every distinct piece
is encoded once by the ``tokenizers`` library, and the ids of the texts are
gathered from those of their pieces. Decoding reverses the byte table: ids to
bytes by one gather, bytes to text with split characters kept whole.

Defined cases: a null or empty text has no ids and decodes to no bytes; ids
outside the vocabulary raise; extra columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import slices

SLICE = 4 << 20
# distinct pieces remembered by one Python worker before it starts afresh
CACHE_PIECES = 400_000
ENCODED = "array<int>"


def byte_table() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable bytes stand
    for themselves, the others for code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class _Parts(dict):
    """Number of each part; unseen parts are learned as they are met."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> int:
        k = self[part] = self.learn(part)
        return k


class Codec:
    """The vocabulary in one Python worker, with its cache of encoded pieces."""

    _made: dict[tuple, Codec] = {}

    def __init__(self, model: str, ranks: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        self.tokenizer.encode_special_tokens = True
        self.find = regex.compile(pattern).findall
        self.runs = regex.compile(r"\s\s|^\s|\s$").search
        self.cut = regex.compile(r"(?<=\S) (?=\S)").split
        self.to_char = {b: ch for ch, b in byte_table().items()}
        self.tokenize = self.tokenizer.model.tokenize
        with open(ranks, "rb") as f:
            pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, f))
        assert [r for r, _ in pairs] == list(range(len(pairs)))
        self.size = len(pairs)
        self.body = np.frombuffer(b"".join(t for _, t in pairs), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) for _, t in pairs])]).astype(np.int64)
        self._clear()

    @classmethod
    def of(cls, *files: str) -> Codec:
        if files not in cls._made:
            cls._made[files] = cls(*files)
        return cls._made[files]

    def _clear(self) -> None:
        self.known = _Parts(self._learn)
        self.ids: list[list[int]] = []
        self.hits = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the parts met most often, at most half of the cache."""
        names, ids, hits = list(self.known), self.ids, self.hits
        best = np.argsort(-hits, kind="stable")[: CACHE_PIECES // 2].tolist()
        self._clear()
        self.known.update((names[i], k) for k, i in enumerate(best))
        self.ids = [ids[i] for i in best]
        self.hits = hits[best] // 2

    def _learn(self, part: str) -> int:
        """Encode an unseen part: it stands for a space and itself, one that
        begins with a space for the rest of it alone (the first of a line)."""
        ids: list[int] = []
        for piece in self.find(part[1:] if part[:1] == " " else " " + part):
            ids += [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.to_char))]
        self.ids.append(ids)
        return len(self.ids) - 1

    def _parts(self, text: str) -> list[str]:
        """Cut a text at single spaces between other characters, where no match
        of the pattern can reach across; around other white space stay whole."""
        if not text:
            return []
        if self.runs(text):
            parts = self.cut(text)
            parts[0] = " " + parts[0]
            return parts
        parts = []
        for line in text.split("\n"):
            words = line.split(" ")
            words[0] = " " + words[0]
            parts += words
            parts.append(" \n")
        parts.pop()
        return parts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n+1 offsets of the texts."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        found = [self._parts(t) for t in texts]
        count = np.fromiter(map(len, found), np.int64, len(found))
        of = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, count.sum())
        self.hits = np.concatenate([self.hits, np.zeros(len(self.ids) - len(self.hits), np.int64)])
        self.hits += np.bincount(of, minlength=len(self.hits))
        used = np.unique(of)
        size = np.zeros(len(self.ids) + 1, np.int64)
        size[used] = [len(self.ids[k]) for k in used.tolist()]
        flat = np.fromiter(chain.from_iterable(map(self.ids.__getitem__, used.tolist())), np.uint32, size.sum())
        start = np.zeros_like(size)
        start[used] = np.cumsum(size[used]) - size[used]
        n = size[of]
        end = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(start[of] - end[:-1], n) + np.arange(end[-1])]
        return ids, end[np.concatenate([[0], np.cumsum(count)])]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and the n+1 byte offsets of the rows."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("id outside the vocabulary")
        a, n = self.at[ids], self.at[ids + 1] - self.at[ids]
        end = np.concatenate([[0], np.cumsum(n)])
        return self.body[np.repeat(a - end[:-1], n) + np.arange(end[-1])], end[off]

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first, last + 1) of every id in code points; an id that holds
        only a part of a character's bytes covers the whole character."""
        ids, off = self.encode([text])
        char_of = np.repeat(np.arange(len(text)), [len(c.encode()) for c in text])
        n = self.at[ids.astype(np.int64) + 1] - self.at[ids.astype(np.int64)]
        end = np.cumsum(n)
        return [(int(i), int(char_of[e - k]), int(char_of[e - 1]) + 1) for i, e, k in zip(ids, end, n, strict=True)]


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """Files and pattern of an installed vocabulary (never copied)."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", into: str = "ids", files: tuple[str, str, str] | None = None) -> DataFrame:
    """``docs`` with the ids of each text in column ``into`` (replaced if there)."""
    files = files or vocabulary()
    docs = docs.drop(into)
    schema = docs.withColumn(into, F.lit(None).cast(ENCODED)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(*files)
        for b in slices(batches, text, SLICE):
            ids, off = codec.encode([t or "" for t in b.column(text).to_pylist()])
            col = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, col], [*b.schema.names, into])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", into: str = "text", files: tuple[str, str, str] | None = None) -> DataFrame:
    """``encoded`` with the decoded text in ``into``; bytes that make no
    character (ids cut inside one) become U+FFFD."""
    files = files or vocabulary()
    encoded = encoded.drop(into)
    schema = encoded.withColumn(into, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(*files)
        for b in batches:
            rows = b.column(ids).to_pylist()
            off = np.concatenate([[0], np.cumsum([len(r or ()) for r in rows])]).astype(np.int64)
            flat = np.fromiter((i for r in rows for i in r or ()), np.int64, off[-1])
            body, at = codec.decode(flat, off)
            raw = body.tobytes()
            texts = [raw[at[i] : at[i + 1]].decode("utf-8", "replace") for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, into])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, files: tuple[str, str, str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, decode, digest in one pass."""
    files = files or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(*files)
        for b in slices(batches, "text", SLICE):
            ids, off = codec.encode([t or "" for t in b.column("text").to_pylist()])
            body, at = codec.decode(ids, off)
            raw_ids, raw = ids.astype("<u4").tobytes(), body.tobytes()
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_id"),
                    "n_tokens": pa.array(np.diff(off)),
                    "ids_sha256": [sha(raw_ids[4 * off[i] : 4 * off[i + 1]]) for i in range(b.num_rows)],
                    "decoded_sha256": [sha(raw[at[i] : at[i + 1]]) for i in range(b.num_rows)],
                }
            )

    d = docs.select("doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
