"""Fixed-width bit packing and Elias-Fano sequences over flat arrays of 64-bit words."""

from __future__ import annotations

import numpy as np

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_U = np.uint64


def words_for(count: int, width: int) -> int:
    """64-bit words that hold ``count`` numbers, with one to spare for reads across words."""
    return (count * width + 63) // 64 + 1


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits (0 to 64), lowest bits first, in 64-bit words."""
    values = np.asarray(values, _U)
    out = np.zeros(words_for(len(values), width), _U)
    if width == 0 or not len(values):
        return out
    if width in (8, 16, 32, 64):
        body = values.astype(f"<u{width // 8}").view(np.uint8)
        out.view(np.uint8)[: len(body)] = body
        return out
    place = np.arange(len(values), dtype=_U) * _U(width)
    word, shift = (place >> _U(6)).astype(np.int64), place & _U(63)
    # Numbers that begin in one word are neighbours, and their bits do not overlap: sums are ors.
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[heads]] += np.add.reduceat(values << shift, heads)
    over = np.flatnonzero(shift + _U(width) > _U(64))
    out[word[over] + 1] += values[over] >> (_U(64) - shift[over])
    return out


def take(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    """The packed numbers at ``index``."""
    if width == 0:
        return np.zeros(len(index), _U)
    place = np.asarray(index, _U) * _U(width)
    word, shift = (place >> _U(6)).astype(np.int64), place & _U(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
    return (low | high) & (_U(2**64 - 1) >> _U(64 - width))


def unpack(words: np.ndarray, width: int, count: int) -> np.ndarray:
    """The first ``count`` packed numbers."""
    if width in (8, 16, 32, 64):
        return words.view(np.uint8)[: count * width // 8].view(f"<u{width // 8}").astype(_U)
    return take(words, width, np.arange(count))


_BYTES = _U(0x0101010101010101)
_TOPS = _U(0x8080808080808080)
#: The place of the set bit number r of each byte, at r * 256 + byte.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [8] * 8)[r] for r in range(8) for byte in range(256)], np.int64)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the set bit number ``rank`` of each word: by counts of all its bytes at once, then within a byte."""
    x = word - ((word >> _U(1)) & _U(0x5555555555555555))
    x = (x & _U(0x3333333333333333)) + ((x >> _U(2)) & _U(0x3333333333333333))
    upto = ((x + (x >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _BYTES  # each byte: set bits up to its end
    rank = rank.astype(_U)
    whole = ((((rank * _BYTES) | _TOPS) - upto) & _TOPS) >> _U(7)  # one for each byte that ends before the bit
    bits = ((whole * _BYTES) >> _U(56)) * _U(8)
    left = rank - (((upto << _U(8)) >> bits) & _U(255))
    return bits.astype(np.int64) + _IN_BYTE[((left << _U(8)) | ((word >> bits) & _U(255))).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, ones counted by word.

    Built from numbers, or over a flat array written by ``flat`` (which may be memory-mapped).
    """

    HEADER = 4

    def __init__(self, flat: np.ndarray):
        self.count, self.width, n_high, n_low = (int(x) for x in flat[: self.HEADER])
        at = self.HEADER
        self.high = flat[at : at + n_high]
        self.low = flat[at + n_high : at + n_high + n_low]
        counts = flat[at + n_high + n_low : at + n_high + n_low + (n_high + 2) // 2]
        self.ones = counts.view(np.uint32)[: n_high + 1]
        self.size = at + n_high + n_low + len(counts)
        self._zeros: np.ndarray | None = None

    @staticmethod
    def flat(values: np.ndarray) -> np.ndarray:
        values = np.asarray(values, _U)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> _U(width)).astype(np.int64) if width < 64 else np.zeros(n, np.int64)
        n_high = ((top >> width) + n + 1 + 63) // 64 + 1
        bits = np.zeros(n_high * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(_U)
        low = pack(values & _U((1 << width) - 1), width)
        ones = np.zeros(2 * ((n_high + 2) // 2), np.uint32)
        ones[1 : n_high + 1] = np.cumsum(_POPCOUNT[words.view(np.uint8)].reshape(-1, 8).sum(axis=1))
        return np.concatenate([np.array([n, width, n_high, len(low)], _U), words, low, ones.view(_U)])

    def _one(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, rank, "right") - 1
        return word * 64 + _select_in_word(self.high[word], rank - self.ones[word].astype(np.int64))

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(self._zeros, rank, "right") - 1
        return word * 64 + _select_in_word(~self.high[word], rank - self._zeros[word])

    def get(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, _U)
        high = (self._one(index) - index).astype(_U)
        return (high << _U(self.width)) | take(self.low, self.width, index)

    def pair(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at ``index`` and at the place after it."""
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, _U), np.zeros(0, _U)
        one = self._one(index)
        above = (self.high[one >> 6] >> (one & 63).astype(_U)) >> _U(1)  # ones higher in the word
        near = above > 0
        following = np.empty(len(index), np.int64)
        lowest = above[near]
        lowest &= ~lowest + _U(1)
        following[near] = one[near] + np.frexp(lowest.astype(np.float64))[1]
        following[~near] = self._one(index[~near] + 1)
        found = ((at - i).astype(_U) << _U(self.width) | take(self.low, self.width, i) for at, i in ((one, index), (following, index + 1)))
        return tuple(found)

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """The place of the first number that is not below ``wanted``; ``count`` if there is none."""
        return self._search(wanted)[0]

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of the first number that equals ``wanted``, or -1."""
        place, met = self._search(wanted)
        return np.where(met, place, -1)

    def _search(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``successor``, and whether it is the number itself."""
        wanted = np.asarray(wanted, _U)
        out, met = np.full(len(wanted), self.count, np.int64), np.zeros(len(wanted), bool)
        if not self.count or not len(wanted):
            return out, met
        last = int(self.get(np.array([self.count - 1]))[0])
        inside = np.flatnonzero(wanted <= _U(last))
        if not len(inside):
            return out, met
        x = wanted[inside]
        high = (x >> _U(self.width)).astype(np.int64)
        end = self._zero(high)
        hi = end - high
        lo = np.where(high > 0, self._zero_before(high, end) - (high - 1), 0)
        target, top = x & _U((1 << self.width) - 1), hi.copy()
        while True:  # halve the runs of equal high bits; most hold one or two numbers
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            below = take(self.low, self.width, mid) < target[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        out[inside] = lo
        same = np.flatnonzero(lo < top)
        met[inside[same]] = take(self.low, self.width, lo[same]) == target[same]
        return out, met

    def _zero_before(self, high: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The zero before the one at ``end``, which is number ``high``: mostly one of the bits just below it."""
        shift = (end & 63).astype(_U)
        below = ~self.high[end >> 6] & ((_U(1) << shift) - _U(1))  # zeros lower in the word
        near = below > 0
        out = np.empty(len(end), np.int64)
        # the highest of them: a float's exponent, after clearing lower bits that could round it up
        top = below[near]
        top &= ~(top >> _U(1))
        out[near] = (end[near] & ~63) + np.frexp(top.astype(np.float64))[1] - 1
        far = np.flatnonzero(~near)
        out[far] = self._zero(np.maximum(high[far] - 1, 0))
        return out
