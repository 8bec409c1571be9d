"""Quality rules as weak supervision.

Each rule votes that a text is good (1) or poor (-1), or abstains (0).  Expectation-maximisation
over the votes of all documents estimates how often each rule votes 'poor' on good and on poor
texts, without labels; the posterior probability that a text is good takes the place of a demand
that all rules pass.  Votes are counted per pattern of votes, of which there are 3 ** rules at
most, so what the driver sees is bounded whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import shared_folder, ship, staged
from daymark.llm.words import code_point_starts, sequence_hashes, span_hashes, split_words

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct",
    "n_symbol_words", "n_alphabetic",
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _vote(poor: Column, good: Column) -> Column:
    return F.when(poor, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules' votes over the feature columns."""
    c = {name: F.col(name) for name in FEATURES}
    words = c["n_words"]
    return {
        "length": _vote(words < 20, words >= 40),
        "repeats": _vote(100 * c["n_repeat_words"] > 30 * words, 100 * c["n_repeat_words"] <= 5 * words),
        "lines": _vote(100 * c["n_dup_lines"] > 30 * c["n_lines"], (c["n_dup_lines"] == 0) & (c["n_lines"] > 1)),
        "symbols": _vote(100 * c["n_symbols"] > 15 * words, 100 * c["n_symbols"] <= 3 * words),
        "symbol_words": _vote(100 * c["n_symbol_words"] > 10 * words, 100 * c["n_symbol_words"] <= 2 * words),
        "letters": _vote(100 * c["n_alphabetic"] < 85 * c["word_chars"], 100 * c["n_alphabetic"] >= 92 * c["word_chars"]),
        "word_length": _vote((c["word_chars"] < 3 * words) | (c["word_chars"] > 15 * words), c["word_chars"] <= 10 * words),
        "capitals": _vote(100 * c["n_upper"] > 40 * c["n_letters"], 100 * c["n_upper"] <= 20 * c["n_letters"]),
        "variety": _vote((words >= 50) & (100 * c["n_distinct"] < 25 * words), 100 * c["n_distinct"] >= 40 * words),
    }


@dataclass
class VoteModel:
    """What the votes say: the share of good texts, and each rule's chance of a 'poor' vote when it votes."""

    good: float
    poor_if_good: np.ndarray
    poor_if_poor: np.ndarray

    def accuracies(self) -> np.ndarray:
        """The chance that a vote of each rule is right."""
        return self.good * (1 - self.poor_if_good) + (1 - self.good) * self.poor_if_poor

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of a good text for each row of votes."""
        down, up = votes == -1, votes == 1
        good = np.log(self.good) + down @ np.log(self.poor_if_good) + up @ np.log1p(-self.poor_if_good)
        poor = np.log1p(-self.good) + down @ np.log(self.poor_if_poor) + up @ np.log1p(-self.poor_if_poor)
        return 1.0 / (1.0 + np.exp(np.clip(poor - good, -700, 700)))


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over distinct rows of votes and how many documents have each.

    It starts from rules that are mostly right, and ten texts' worth of that start stays in every estimate; nothing
    else bounds them, so a rule that misfires on many good texts is found to do so.
    """
    n = votes.shape[1]
    model = VoteModel(0.9, np.full(n, 0.02), np.full(n, 0.4))
    down, up = (votes == -1).astype(float), (votes == 1).astype(float)
    for _ in range(rounds):
        good = model.posterior(votes) * counts
        poor = counts - good

        def share(weight: np.ndarray, start: float) -> np.ndarray:
            low, high = weight @ down, weight @ up
            return (low + 10 * start) / (low + high + 10)  # ten texts' worth of the starting point

        if_good, if_poor = share(good, 0.02), share(poor, 0.4)
        new = VoteModel(float((good.sum() + 9) / (counts.sum() + 10)), if_good, if_poor)
        change = max(abs(new.good - model.good), np.abs(if_good - model.poor_if_good).max(), np.abs(if_poor - model.poor_if_poor).max())
        model = new
        if change < 1e-7:
            break
    return model


def rate_quality(documents: DataFrame, least: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``documents`` with its features, votes, ``quality`` and verdict.

    Returns ``doc_id``, ``text_key`` (a hash of the text), the columns of FEATURES, ``base_failed``,
    ``votes`` (one per rule, in the order of ``rules()``), ``quality``, ``kept`` and ``carried``, a struct of the
    columns in ``carry``.  A null text has no words and fails the base.  Features follow from a text
    alone, so equal texts get equal verdicts.
    """
    spark = documents.sparkSession
    ship(spark)
    folder = shared_folder(spark, "quality")
    fields = ", ".join(f"{name} long" for name in FEATURES)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text",
        F.struct(F.lit(None).cast("int").alias("none"), *(documents[name] for name in carry)).alias("carried"),
    )
    carried = rows.schema["carried"].dataType.simpleString()
    measured = rows.mapInArrow(_features, f"doc_id long, text_key long, carried {carried}, {fields}")
    votes = list(rules().values())
    code = sum(((vote + 1) * 3**i for i, vote in enumerate(votes)), F.lit(0)).cast("int")
    voted = staged(measured.withColumn("votes", F.array(*votes)).withColumn("pattern", code), folder, "voted")
    patterns = voted.groupBy("pattern", "votes").agg(F.count("*").alias("n")).collect()
    if patterns:
        table = np.array([row.votes for row in patterns])
        model = fit(table, np.array([row.n for row in patterns], float))
        quality = [(row.pattern, float(p)) for row, p in zip(patterns, model.posterior(table))]
    else:
        quality = []
    known = F.broadcast(spark.createDataFrame(quality, "pattern int, quality double"))  # 3 ** rules rows at most
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        voted.join(known, "pattern")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (F.col("quality") >= least))
        .select("doc_id", "text_key", *FEATURES, "base_failed", "votes", "quality", "kept", "carried")
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in split_words(batch.column(2)):
            hashes, owner = w.hashes(), w.owner()
            chars = np.concatenate([[0], np.cumsum(code_point_starts(w.data))])
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[w.data])])
            lines, repeated_lines = _lines(w)
            measures = {
                "n_words": np.diff(w.first),
                "word_chars": np.bincount(owner, chars[w.end] - chars[w.begin], w.texts),
                "n_symbols": _per_text(_SYMBOL[w.data], w.edges),
                "n_dup_lines": repeated_lines,
                "n_repeat_words": _repeat_words(w, hashes, owner),
                "n_lines": lines,
                "n_upper": _per_text(_UPPER[w.data], w.edges),
                "n_letters": _per_text(_LETTER[w.data], w.edges),
                "n_symbol_words": np.bincount(owner, symbols[w.end] > symbols[w.begin], w.texts),
                "n_alphabetic": _per_text(_LETTER[w.data] | (w.data >= 0xC0), w.edges),
                "n_distinct": np.bincount(owner[_first_of_equal(owner, hashes)], minlength=w.texts),
            }
            rows = batch.slice(w.lo, w.texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), rows.column(3), *(pa.array(np.asarray(measures[f], np.int64)) for f in FEATURES)],
                ["doc_id", "text_key", "carried", *FEATURES],
            )


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags)])
    return upto[edges[1:]] - upto[edges[:-1]]


def _first_of_equal(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The first place of each distinct hash within each text."""
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return order[new]


def _lines(w) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line, for each text."""
    breaks = np.flatnonzero(w.data == 10)
    begin = np.sort(np.concatenate([w.edges[:-1], breaks + 1]))
    owner = np.searchsorted(w.edges, begin, "right") - 1
    # a break at the end of a text begins an empty last line of that text, not a line of the next
    end = np.sort(np.concatenate([w.edges[1:], breaks]))
    some = np.searchsorted(w.begin, end) > np.searchsorted(w.begin, begin)
    begin, end, owner = begin[some], end[some], owner[some]
    first = _first_of_equal(owner, span_hashes(w.data, begin, end))
    lines = np.bincount(owner, minlength=w.texts)
    return lines, lines - np.bincount(owner[first], minlength=w.texts)


def _repeat_words(w, hashes: np.ndarray, owner: np.ndarray, length: int = 8) -> np.ndarray:
    """Words in windows of ``length`` words that are found twice or more in the text."""
    starts = np.flatnonzero(np.arange(len(w)) + length <= w.first[1:][owner])
    if not len(starts):
        return np.zeros(w.texts, np.int64)
    windows = sequence_hashes(hashes, starts, length)
    order = np.lexsort((windows, owner[starts]))
    same = np.zeros(len(order), bool)
    same[1:] = (windows[order][1:] == windows[order][:-1]) & (owner[starts][order][1:] == owner[starts][order][:-1])
    same[:-1] |= same[1:]
    found = starts[order[same]]
    covered = np.zeros(len(w) + 1, np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + length, -1)
    return np.bincount(owner, np.cumsum(covered)[:-1] > 0, w.texts).astype(np.int64)
