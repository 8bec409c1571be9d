"""Lists of numbers for repeated byte spans, made once for each distinct span."""

from __future__ import annotations

import secrets
from collections.abc import Callable

import numpy as np

from daymark.llm.words import gather, span_hashes

Make = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class _Known:
    """Numbers by span: runs sorted by hash, each at least twice as long as the next, over one flat array."""

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, ...]] = []  # hashes, second hashes, starts in ``flat``, lengths
        self.flat = np.zeros(1 << 12, np.int32)
        self.used = 0

    @property
    def bytes(self) -> int:
        return self.flat.nbytes + sum(x.nbytes for run in self.runs for x in run)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Start (-1: unknown) and length for each key, and whether a key is that of another span."""
        starts, lengths = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        new, clash = np.arange(len(keys)), False
        for its_keys, its_checks, its_starts, its_lengths in self.runs:
            place = np.searchsorted(its_keys, keys[new])
            known = place < len(its_keys)
            known[known] = its_keys[place[known]] == keys[new[known]]
            rows, place = new[known], place[known]
            clash |= bool((its_checks[place] != checks[rows]).any())
            starts[rows], lengths[rows] = its_starts[place], its_lengths[place]
            new = new[~known]
        return starts, lengths, clash

    def add(self, keys: np.ndarray, checks: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Remember spans that are not known; returns their starts."""
        upto = self.used + len(flat)
        if upto > len(self.flat):
            grown = np.zeros(max(upto, len(self.flat) * 3 // 2), np.int32)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : upto] = flat
        starts = np.cumsum(lengths) - lengths + self.used
        self.used = upto
        order = np.argsort(keys, kind="stable")
        run = tuple(x[order] for x in (keys, checks, starts, lengths))
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            both = [np.concatenate(x) for x in zip(self.runs.pop(), run)]
            order = np.argsort(both[0], kind="stable")
            run = tuple(x[order] for x in both)
        self.runs.append(run)
        return starts


class Memo:
    """Remembers what ``make`` gave for distinct spans, in about ``most_bytes``.

    ``make`` takes ``(data, begin, end)`` of spans and returns their numbers, one after the other,
    and how many each has.  There are a new and an old half: a full new half becomes the old one,
    and what is used again of the old one goes to the new one, so that frequent spans stay.

    A span is told by two hashes, the second of them seeded anew in every process.  Spans that
    share the first and not the second are made again, all spans of their call with them.
    """

    def __init__(self, make: Make, most_bytes: int = 64 << 20):
        self.make, self.most_bytes = make, most_bytes
        self.new, self.old = _Known(), _Known()
        self.seed = secrets.randbits(60)

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all spans, one after the other, and how many each has."""
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, checks = span_hashes(data, begin, end), span_hashes(data, begin, end, self.seed)
        distinct, example, number = np.unique(keys, return_index=True, return_inverse=True)
        if self.new.bytes > self.most_bytes // 2:
            self.new, self.old = _Known(), self.new
        check = checks[example]
        starts, lengths, clash = self.new.find(distinct, check)
        clash |= bool((check[number] != checks).any())
        new = np.flatnonzero(starts < 0)
        old_starts, old_lengths, old_clash = self.old.find(distinct[new], check[new])
        if clash or old_clash:
            return self.make(data, begin, end)
        if len(new):
            again = old_starts >= 0
            unseen = new[~again]
            flat, made = self.old.flat[gather(old_starts[again], old_lengths[again])], old_lengths[again]
            if len(unseen):
                more, its = self.make(data, begin[example[unseen]], end[example[unseen]])
                flat, made = np.concatenate([flat, more]), np.concatenate([made, its])
            rows = np.concatenate([new[again], unseen])
            starts[rows], lengths[rows] = self.new.add(distinct[rows], check[rows], flat, made), made
        return self.new.flat[gather(starts[number], lengths[number])], lengths[number]
