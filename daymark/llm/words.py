"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, within one text; a null text has
none.  Word and sequence hashes are 64 bits wide and the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is handled whole, alone.
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words up to this long are hashed eight bytes at a time, all words at once; longer ones one by one.
_LANES_BYTES = 512
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values so that every bit depends on every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's longs, bit by bit."""
    return np.asarray(x, np.uint64).view(np.int64)


@dataclass
class Words:
    """The words of the texts ``lo:hi`` of a batch.

    ``first[i]:first[i + 1]`` are the words of the i-th of these texts, ``begin`` and ``end``
    their byte places in ``data``; ``edges[i]:edges[i + 1]`` are the bytes of the text.
    """

    lo: int
    hi: int
    data: np.ndarray
    edges: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> int:
        return self.hi - self.lo

    def __len__(self) -> int:
        return len(self.begin)

    def owner(self) -> np.ndarray:
        """The text of each word, counted from ``lo``."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.begin, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each byte span; another one for another seed.

    Every eight bytes are scattered together with what came before, so that no two spans of
    repeated patterns have one hash by construction.
    """
    length = np.asarray(end - begin, np.int64)
    out = mix(length.astype(np.uint64) * _FACTOR + np.uint64(seed))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    long = length > _LANES_BYTES
    rows = np.flatnonzero(~long & (length > 0))
    done = 0
    while len(rows):
        lane = eights[begin[rows] + done] & _KEPT[np.minimum(length[rows] - done, 8)]
        out[rows] = mix(out[rows] * _FACTOR + lane)
        done += 8
        rows = rows[length[rows] > done]
    for i in np.flatnonzero(long).tolist():
        digest = blake2b(data[begin[i] : end[i]], digest_size=8, salt=seed.to_bytes(16, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def sequence_hashes(hashes: np.ndarray, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """A hash of each run of ``length`` words that starts at ``begin``, from hashes of runs of 1, 2, 4, 8 ... words."""
    at = np.array(begin, np.int64)
    length = np.asarray(length, np.int64)
    out = mix(np.broadcast_to(length, at.shape).astype(np.uint64) * _FACTOR + np.uint64(1))
    runs, span, most = hashes, 1, int(length.max()) if length.size and len(at) else 0
    while span <= most:
        if not length.ndim:
            if length & span:
                out, at = mix(out * _FACTOR + runs[at]), at + span
        else:
            rows = np.flatnonzero(length & span)
            out[rows] = mix(out[rows] * _FACTOR + runs[at[rows]])
            at[rows] += span
        if 2 * span <= most:
            runs = mix(runs[:-span] * _FACTOR + runs[span:])
        span *= 2
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), data


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, edges, data)`` for runs of texts of about ``size`` bytes together."""
    offsets, data = text_buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
        lo = hi


def split_words(column: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a text column in chunks; ``lower`` turns A-Z into a-z first."""
    for lo, hi, edges, data in chunks(column, size):
        yield words_of(lo, hi, edges, _LOWER[data] if lower else data)


def words_of(lo: int, hi: int, edges: np.ndarray, data: np.ndarray) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[edges] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return Words(lo, hi, data, edges, begin, end, np.searchsorted(begin, edges))


def code_point_starts(data: np.ndarray) -> np.ndarray:
    """True for each byte that begins a character."""
    return (data & 0xC0) != 0x80


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i] : starts[i] + lengths[i]`` for all i, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def unique_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the place of an example of each, and each span's number among them."""
    hashes = span_hashes(data, begin, end)
    distinct, example, number = np.unique(hashes, return_index=True, return_inverse=True)
    return distinct, example, number


def binary_column(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """The byte spans as an Arrow column."""
    lengths = end - begin
    offsets = np.zeros(len(begin) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    body = data[gather(begin, lengths)]
    return pa.Array.from_buffers(kind, len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def shingle_sets(w: Words, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted: their hashes, and where each text's begin.

    A text with fewer than ``gram`` words has its whole word sequence as its one shingle.
    """
    counts = np.diff(w.first)
    enough = counts >= gram
    number = np.where(enough, counts - gram + 1, counts > 0)
    starts = gather(w.first[:-1], number)
    lengths = np.repeat(np.where(enough, gram, counts), number)
    hashes = sequence_hashes(w.hashes(), starts, lengths)
    owner = np.repeat(np.arange(w.texts), number)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(w.texts + 1))


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the values of each text."""
    upto = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=upto[1:])
    return upto[first[1:]] - upto[first[:-1]]
