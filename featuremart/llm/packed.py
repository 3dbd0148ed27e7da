"""Sorted integers as short bytes: differences in 7-bit groups, low group first."""

from __future__ import annotations

import numpy as np

_STEPS = np.array([1 << (7 * k) for k in range(1, 10)], np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers below 2^63, one to nine bytes each."""
    v = values.astype(np.uint64)
    size = np.searchsorted(_STEPS, v, "right") + 1
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    at, todo = end - size, np.arange(len(v))
    k = 0
    while len(todo):
        more = size[todo] > k + 1
        group = (v[todo] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[todo] + k] = group.astype(np.uint8) | (more.astype(np.uint8) << 7)
        todo = todo[more]
        k += 1
    return out.tobytes()


def unpack(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    end = np.flatnonzero(raw < 128) + 1
    size = np.diff(end, prepend=0)
    at, todo = end - size, np.arange(len(end))
    out = np.zeros(len(end), np.int64)
    k = 0
    while len(todo):
        out[todo] |= (raw[at[todo] + k] & 127).astype(np.int64) << (7 * k)
        todo = todo[size[todo] > k + 1]
        k += 1
    return out


def pack_counted(keys: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Ordered distinct keys with counts from 1: the lowest bit of a difference
    says whether the count is above 1, and only then is it written."""
    more = n > 1
    return pack(np.diff(keys, prepend=0) * 2 + more), pack(n[more] - 2)


def unpack_counted(keys, counts) -> tuple[np.ndarray, np.ndarray]:
    d = unpack(keys)
    n = np.ones(len(d), np.int64)
    n[(d & 1) == 1] = unpack(counts) + 2
    return np.cumsum(d >> 1), n


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, n
    if n.max() == n.min():  # as before any summing: only keys are sorted
        keys = np.sort(keys)
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[start], np.diff(np.append(start, len(keys))) * n[0]
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[start], np.add.reduceat(n, start)
