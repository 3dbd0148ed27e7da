"""Plain Python versions of the operators, one text at a time."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from itertools import combinations

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def windows(text: str | None, width: int = 10) -> list[tuple[str, ...]]:
    w = ALNUM_WORD.findall((text or "").translate(LOWER))
    if not w:
        return []
    return [tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)]


def contamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    found: dict[tuple, set] = {}
    for item, text in items:
        for g in windows(text):
            found.setdefault(g, set()).add(str(item))
    out = []
    for doc, text in docs:
        w = ALNUM_WORD.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for g, who in found.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    ids |= who
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def fingerprint(text: str | None, width: int = 4) -> int:
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    cuts = [" ".join(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)]
    h = [xxhash.xxh64_intdigest(c.encode(), 42) for c in cuts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(docs: list[tuple], distance: int = 4) -> list[tuple]:
    """(doc_id, fingerprint, component_id)."""
    fp = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= distance:
            root[find(i)] = find(j)
    low: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, f"{fp[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(docs)]


def repeats(docs: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept text)."""
    words = [SPACE_WORD.findall(t or "") for _, t in docs]
    first: dict[tuple, int] = {}
    for (d, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            if d is not None:
                g = tuple(w[i : i + window])
                first[g] = min(first.get(g, d), d)
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def greedy(text: str | None, pieces: set[bytes]) -> int:
    longest = max(map(len, pieces), default=1)
    n = 0
    for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        w = b" " + w
        while w:
            k = next((k for k in range(min(longest, len(w)), 1, -1) if w[:k] in pieces), 1)
            w, n = w[k:], n + 1
    return n


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
