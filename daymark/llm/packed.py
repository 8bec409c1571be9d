"""Sorted number arrays in a few bytes each, for shuffles of packed blocks."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """First all lowest bytes, then all second ones, and so on: high bytes, mostly zero, compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(blob: memoryview, count: int, kind: type) -> np.ndarray:
    flat = np.frombuffer(blob, np.uint8, count * np.dtype(kind).itemsize).reshape(np.dtype(kind).itemsize, count)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, with a count each."""
    return planes(np.diff(keys, prepend=np.uint64(0))) + planes(counts.astype(np.uint64))


def unpack_counts(blob: memoryview) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 16
    return np.cumsum(from_planes(blob, n, np.uint64), dtype=np.uint64), from_planes(blob[8 * n :], n, np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts[:0]
