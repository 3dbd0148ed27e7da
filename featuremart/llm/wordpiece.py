"""Operator 1: token counts by a linear longest-match automaton.

The vocabulary is a byte trie. A node's failure link leads to the node of
what is left after the greedy pieces that can be popped there, and the number
of these pieces is stored with it. Walking a word follows edges and failure
links and adds up the popped counts, so greedy longest-match lengths come out
in time linear in the word, with no piece built. The distinct words of a
batch walk in lockstep.

A word (bytes other than space and 0x09-0x0D) is matched with one space before
it, as in byte-level vocabularies. Defined cases: null and empty texts have
no words and no tokens; a byte that no piece starts with counts as one token.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from featuremart.llm.text import SPACE_WORDS, row_sums, slices, span_hash, utf8, word_spans

LONG_WORD = 256  # bytes from which a word walks alone


class Automaton:
    """Trie with failure links; node 0 is the root."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        final = [False]
        # every byte alone is matched, so that no text is without a count
        for piece in [*(bytes([b]) for b in range(256)), *pieces]:
            at = 0
            for b in piece:
                nxt = children[at].get(b)
                if nxt is None:
                    nxt = children[at][b] = len(children)
                    children.append({})
                    final.append(False)
                at = nxt
            final[at] = at > 0
        fail, pops = [0] * len(children), [0] * len(children)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for b, v in children[u].items():
                queue.append(v)
                if final[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, n = fail[u], pops[u]
                while b not in children[z]:
                    z, n = fail[z], n + pops[z]
                fail[v], pops[v] = children[z][b], n
        rest = [0] * len(children)  # pieces popped when a word ends at a node
        for v in range(1, len(children)):
            z, n = v, 0
            while z:
                z, n = fail[z], n + pops[z]
            rest[v] = n
        self.children, self.fail, self.pops, self.rest = children, np.array(fail, np.int32), np.array(pops, np.int32), np.array(rest, np.int32)
        inner = [u for u, c in enumerate(children) if c]
        self.row = np.zeros(len(children), np.int32)
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.next = np.full((len(inner) + 1, 256), -1, np.int32)  # row 0: no edges
        for k, u in enumerate(inner, 1):
            self.next[k, list(children[u])] = list(children[u].values())

    def count(self, word: bytes) -> int:
        """Greedy pieces of one word."""
        at = n = 0
        for b in word:
            while b not in self.children[at]:
                at, n = int(self.fail[at]), n + int(self.pops[at])
            at = self.children[at][b]
        return n + int(self.rest[at])

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Greedy pieces of a space and each span of ``data``, in lockstep."""
        size = ends - starts
        out = np.zeros(len(starts), np.int64)
        order = np.argsort(-size, kind="stable")
        long = int(np.count_nonzero(size > LONG_WORD))
        for i in order[:long].tolist():
            out[i] = self.count(b" " + data[starts[i] : ends[i]].tobytes())
        order = order[long:]
        at = starts[order]
        state = np.full(len(order), self.children[0][0x20], np.int32)
        n = np.zeros(len(order), np.int64)
        left = size[order]
        live = len(order)
        for k in range(int(left[0]) if live else 0):
            live = int(np.searchsorted(-left, -k))  # words of more than k bytes come first
            byte = data[at[:live] + k]
            s = state[:live]
            to = self.next[self.row[s], byte]
            miss = np.flatnonzero(to < 0)
            while len(miss):
                m = s[miss]
                n[miss] += self.pops[m]
                s[miss] = self.fail[m]
                found = self.next[self.row[s[miss]], byte[miss]]
                to[miss] = found
                miss = miss[found < 0]
            state[:live] = to
        out[order] = n + self.rest[state]
        return out


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a vocabulary file of base64 pieces and ranks."""
    with open(path, "rb") as f:
        return [base64.b64decode(x.split()[0]) for x in f if x.strip()]


_made: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    if path not in _made:
        _made[path] = Automaton(read_pieces(path))
    return _made[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens of every whole text."""
    path = path or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = automaton(path)
        for b in slices(batches, text, 8 << 20):
            data, off = utf8(b.column(text))
            s, e, rows = word_spans(data, off, SPACE_WORDS)
            _, first, of = np.unique(span_hash(data, s, e), return_index=True, return_inverse=True)
            n = trie.counts(data, s[first], e[first])[of]
            cols = [b.column(id_col), pa.array(np.diff(off)), pa.array(np.diff(rows)), pa.array(row_sums(n, rows))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_words", "n_tokens"])

    return docs.select(id_col, text).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_words long, n_tokens long")
