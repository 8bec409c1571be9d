"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

The patterns find assignments, access keys and long hex numbers.  Beyond them, whatever stands
where a credential would ("pwd: ...", "passphrase is ...") is a secret if it is costly
to guess: the least cost over all ways to cut it into dictionary words, dates, repeats, keyboard
walks and brute-force spans, by dynamic programming.  The dictionary is the corpus's own frequent words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import most_frequent, partitions, shared_folder, ship
from daymark.llm.words import binary_column, split_words, unique_spans

#: Words of the guessing dictionary; bounds what the driver collects and sends to tasks.
DICTIONARY_WORDS = 20_000
#: Slots that texts are hashed to, as a power of two; a text alone in its slot has no copy.  One bit each goes to tasks.
SLOT_BITS = 27
_SEGMENT_BITS = 19

# fixed values: the base patterns, the least length of a match (of group 2 for assign)
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 20),
    ("hex", r"[0-9a-f]+", re.ASCII, 0, 24),
)
# matches of 24 digits and more only begin where a run begins, so shorter runs need not be listed
_FAST = {"hex": r"[0-9a-f]{24,}"}
_BASE = [(kind, re.compile(_FAST.get(kind, pattern), flags), group, least) for kind, pattern, flags, group, least in BASE]

_CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth(?:[_-]?key)?|bearer|private[_-]?key)"""
    r"""["']?\x20*(?:is|=>|:=|[:=])\x20*["'`]?([^\s"'`<>]{6,})""",
    re.ASCII | re.IGNORECASE,
)
# RE2 folds more letters than ASCII's, so this lets through all that the patterns above can match
_LIKELY = r"(?i)pass|pwd|secret|token|api[_-]?key|credential|auth|bearer|private[_-]?key"
_LIKELY_BASE = r"AKIA|[0-9a-f]{24}"


def scan_secrets(documents: DataFrame, dictionary: dict[str, int], least_log10: float = 10.0) -> DataFrame:
    """``doc_id`` and ``spans``: kind, start, end (code points, end exclusive) and log10_guesses.

    Kinds are those of BASE, and ``guess`` for a value in a credential context that no base match
    covers and that takes ``10 ** least_log10`` guesses or more.  Spans are in order of start,
    then kind as listed.  log10_guesses is the cost of the secret part (null for access and hex).
    Null and empty texts have none.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(dictionary)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        lambda batches: _scan(batches, sent.value, least_log10),
        "doc_id long, spans array<struct<kind:string,start:long,end:long,log10_guesses:double>>",
    )


def guess_dictionary(documents: DataFrame, words: int = DICTIONARY_WORDS) -> dict[str, int]:
    """The rank of each frequent word of all distinct texts, letters only and in lower case.

    Words are cleaned before they are counted and ranked.  What a base pattern or a credential context
    gives as a value is not counted, so a secret that is often repeated does not become easy to guess.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = documents.where("text is not null").select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"), "text")
    counts = "word string, n long"
    # those alone are filtered and counted by one worker of a task
    alone, others = split_alone(texts, _word_counts, counts)
    counted = alone.unionByName(others.dropDuplicates(["h1", "h2"]).mapInArrow(_word_counts, counts))
    top = most_frequent(counted, words, shared_folder(spark, "dictionary"))
    return {row.word: rank for rank, row in enumerate(top, 1)}


def split_alone(texts: DataFrame, of_alone: Callable, schema: str) -> tuple[DataFrame, DataFrame]:
    """What ``of_alone`` makes of the batches of rows (``h1``, ``h2``, ``text``) that are certain to have no copy, and all other rows.

    Only hashes are shuffled to tell.  The fewer slots there are for the rows, the more rows without a
    copy are among the others; none with a copy is ever among those alone.
    """
    spark, bits = texts.sparkSession, SLOT_BITS
    slots = texts.groupBy(F.col("h1").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot")).agg(F.count("*").alias("n"))
    met = slots.where("n > 1").select("slot").repartition(partitions(spark), F.shiftright("slot", _SEGMENT_BITS))
    taken = np.zeros(max(1, 1 << bits >> _SEGMENT_BITS) << (_SEGMENT_BITS - 3), np.uint8)
    for segment, blob in met.mapInArrow(_bitmaps, "segment long, bits binary").collect():
        taken[segment << (_SEGMENT_BITS - 3) : (segment + 1) << (_SEGMENT_BITS - 3)] |= np.frombuffer(zlib.decompress(blob), np.uint8)
    sent = spark.sparkContext.broadcast(taken)
    alone = texts.mapInArrow(lambda batches: of_alone(_by_slot(batches, sent.value, bits, False)), schema)
    return alone, texts.mapInArrow(lambda batches: _by_slot(batches, sent.value, bits, True), texts.schema)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of the slots in each segment, compressed."""
    for batch in batches:
        slots = np.sort(batch.column(0).to_numpy())
        segments, first = np.unique(slots >> _SEGMENT_BITS, return_index=True)
        for segment, some in zip(segments.tolist(), np.split(slots, first[1:])):
            bits = np.zeros(1 << _SEGMENT_BITS, bool)
            bits[some & ((1 << _SEGMENT_BITS) - 1)] = True
            blob = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([blob], pa.binary())], ["segment", "bits"])


def _by_slot(batches: Iterator[pa.RecordBatch], taken: np.ndarray, bits: int, met: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose slot another row has as well (``met``), or has not."""
    for batch in batches:
        slot = batch.column(0).to_numpy() & ((1 << bits) - 1)
        yield batch.filter(pa.array(((taken[slot >> 3] >> (slot & 7)) & 1 == 1) == met))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in split_words(_without_values(batch.column("text")), lower=True, size=4 << 20):
            if len(w):
                distinct, example, number = unique_spans(w.data, w.begin, w.end)
                counts = np.bincount(number, minlength=len(distinct))
                found = binary_column(w.data, w.begin[example], w.end[example]).to_pylist()
                cleaned: dict[str, int] = {}
                for token, n in zip(found, counts.tolist()):
                    word = _letters(token.decode())
                    if len(word) > 1:
                        cleaned[word] = cleaned.get(word, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cleaned.keys(), pa.string()), pa.array(cleaned.values(), pa.int64())], ["word", "n"]
                )


def _letters(token: str) -> str:
    token = token.lower()
    return token if token.isalpha() else "".join(c for c in token if c.isalpha())


def _without_values(texts: pa.Array) -> pa.Array:
    """The texts with blanks for the values that the patterns and contexts find."""
    rows = np.flatnonzero(_likely(texts).to_numpy(zero_copy_only=False))
    if not len(rows):
        return texts
    out = texts.to_pylist()
    for i in rows.tolist():
        text, parts, at = out[i], [], 0
        values = [m.span(group) for _, pattern, group, least in _BASE for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        for begin, end in sorted(values + [m.span(1) for m in _CONTEXT.finditer(text)]):
            if end > at:
                parts.append(text[at : max(at, begin)])
                at = end
        out[i] = " ".join([*parts, text[at:]])
    return pa.array(out, texts.type)


def _likely(texts: pa.Array) -> pa.Array:
    found = pc.or_(pc.match_substring_regex(texts, _LIKELY), pc.match_substring_regex(texts, _LIKELY_BASE))
    return pc.fill_null(found, False)


def _scan(batches: Iterator[pa.RecordBatch], dictionary: dict[str, int], least_log10: float) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())]))
    cost = GuessCost(dictionary)
    for batch in batches:
        texts = batch.column(1)
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for i in np.flatnonzero(_likely(texts).to_numpy(zero_copy_only=False)).tolist():
            found[i] = spans_of(texts[i].as_py(), cost, least_log10)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def spans_of(text: str, cost: GuessCost, least_log10: float) -> list[dict]:
    """The spans of one text, as ``scan_secrets`` describes them."""
    found = []
    covered: list[tuple[int, int]] = []
    for order, (kind, pattern, group, least) in enumerate(_BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                guesses = cost(m.group(group)) if kind == "assign" else None
                found.append((m.start(), order, kind, m.end(), guesses))
                covered.append((m.start(), m.end()))
    for m in _CONTEXT.finditer(text):
        value = m.group(1).rstrip(".,;:!?)]}")
        start, end = m.start(1), m.start(1) + len(value)
        if len(value) >= 6 and not any(a < end and start < b for a, b in covered):
            guesses = cost(value)
            if guesses >= least_log10:
                found.append((start, len(_BASE), "guess", end, guesses))
    return [
        {"kind": kind, "start": start, "end": end, "log10_guesses": guesses}
        for start, _, kind, end, guesses in sorted(found, key=lambda x: x[:2])
    ]


# fixed values: the rows of a US keyboard, plain and shifted
_ROWS = (("1234567890-=", "!@#$%^&*()_+"), ("qwertyuiop[]", "QWERTYUIOP{}"), ("asdfghjkl;'", 'ASDFGHJKL:"'), ("zxcvbnm,./", "ZXCVBNM<>?"))
_KEYS = {c: (y, x) for y, row in enumerate(_ROWS) for letters in row for x, c in enumerate(letters)}
_LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}
_DATE = re.compile(
    r"(?:(?P<y1>19\d\d|20\d\d)([-/._]?)(?:0?[1-9]|1[0-2])\2(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|[12]\d|3[01])\3(?P<y2>19\d\d|20\d\d)|(?P<y3>19\d\d|20\d\d))"
)
_WORD_MOST = 32
_PERIOD_MOST = 8
_CUT = math.log10(2)


class GuessCost:
    """log10 of the guesses for a value: the least sum over its segmentations, with a factor of 2 for each cut."""

    def __init__(self, dictionary: dict[str, int]):
        self.ranks = dictionary

    def __call__(self, value: str) -> float:
        n = len(value)
        best = [0.0] + [math.inf] * n
        runs = self._repeats(value)
        walks = self._walks(value)
        plain = value.lower()
        unleet = "".join(_LEET.get(c, c) for c in plain)
        for i in range(n):
            here = best[i] + (_CUT if i else 0.0)
            # brute force may go on without a cut
            single = _char_cost(value[i])
            best[i + 1] = min(best[i + 1], best[i] + single)
            for j in range(i + 2, min(n, i + _WORD_MOST) + 1):
                rank = self.ranks.get(plain[i:j])
                extra = 0.0
                if rank is None and unleet[i:j] != plain[i:j]:
                    rank = self.ranks.get(unleet[i:j])
                    extra = _CUT * sum(a != b for a, b in zip(unleet[i:j], plain[i:j]))
                if rank is not None:
                    best[j] = min(best[j], here + math.log10(rank) + extra + _case_cost(value[i:j]))
            m = _DATE.match(value, i)
            if m:
                year = int(m.group("y1") or m.group("y2") or m.group("y3"))
                days = 1 if m.group("y3") else 365
                best[m.end()] = min(best[m.end()], here + math.log10(days * max(20, abs(year - 2000))) + 2 * _CUT)
            for j, price in runs.get(i, ()):
                best[j] = min(best[j], here + price)
            for j, price in walks.get(i, ()):
                best[j] = min(best[j], here + price)
        return best[n]

    @staticmethod
    def _repeats(value: str) -> dict[int, list[tuple[int, float]]]:
        """For each place, where repeats of short strings that begin there may end, and the cost."""
        out: dict[int, list[tuple[int, float]]] = {}
        n = len(value)
        for period in range(1, min(_PERIOD_MOST, n // 2) + 1):
            same = 0  # how many characters from i on equal those a period later
            for i in range(n - period - 1, -1, -1):
                same = same + 1 if value[i] == value[i + period] else 0
                times = 1 + same // period
                if times >= 2 and period * times >= 3:
                    unit = sum(_char_cost(c) for c in value[i : i + period])
                    out.setdefault(i, []).append((i + period * times, unit + math.log10(times)))
        return out

    @staticmethod
    def _walks(value: str) -> dict[int, list[tuple[int, float]]]:
        """For each place, where keyboard walks of three keys and more may end, and the cost."""
        out: dict[int, list[tuple[int, float]]] = {}
        n = len(value)
        steps = []
        for a, b in zip(value, value[1:]):
            ka, kb = _KEYS.get(a), _KEYS.get(b)
            step = (kb[0] - ka[0], kb[1] - ka[1]) if ka and kb else None
            near = step is not None and step != (0, 0) and abs(step[0]) <= 1 and abs(step[1]) <= 1
            steps.append(step if near else None)
        for i in range(n - 2):
            turns, last = 0, None
            for j in range(i, min(n - 1, i + _WORD_MOST)):
                if steps[j] is None:
                    break
                turns += steps[j] != last
                last = steps[j]
                length = j + 2 - i
                if length >= 3:
                    out.setdefault(i, []).append((j + 2, math.log10(47 * length) + turns * math.log10(4.6)))
        return out


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _case_cost(word: str) -> float:
    if word.islower():
        return 0.0
    upper = sum(c.isupper() for c in word)
    if upper == 0:
        return 0.0
    if word.isupper() or (upper == 1 and (word[0].isupper() or word[-1].isupper())):
        return _CUT
    return math.log10(sum(math.comb(len(word), k) for k in range(1, min(upper, len(word) - upper) + 1)) or 1)
