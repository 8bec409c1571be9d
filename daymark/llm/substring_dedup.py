"""Substring dedup: seed and extend over winnowed anchors.

Repeats of at least ``length`` words are found in three steps, none of which pairs documents:

1. *Seeds.*  Winnowing picks, in every window of ``length`` words, the least hash of a run of
   ``gram`` words.  Equal windows pick the same run, so each repeat holds a common anchor.
2. *Extension.*  The windows that picked one anchor lie side by side; together they are the
   anchor's reach, as far left and right as the anchor can vouch for.  Where every occurrence of
   an anchor has the same reach, the reach repeats as a whole.  Where reaches differ, one
   example of each distinct reach is extended word by word: its windows are counted over all
   reaches of that anchor.
3. *Maximal repeats.*  The repeated windows of a document, joined where they overlap, are its
   maximal repeats; their words go.

Windows are judged on the input.  A hot passage is one reach after partial aggregation, and
joins back to occurrences are plain joins, which Spark splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import row_key, shared_folder, ship, staged
from daymark.llm.words import gather, mix, sequence_hashes, signed, split_words, text_buffers, words_of

_OCCURRENCES = "key long, text_key long, a int, b int, anchor long, reach long"
_WINDOWS = "key long, text_key long, a int, anchor long, window long, n long"


def remove_repeats(documents: DataFrame, length: int = 35, gram: int = 8) -> DataFrame:
    """Each document without the words of its repeats.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one
    space) and ``repeats`` (maximal repeats as ``[begin, end)`` word places).  Null and empty
    texts have no words and ``kept`` ''.  Equal rows are documents of their own, so each repeats
    the other.  A text shorter than ``length`` words has no window and is kept whole.
    """
    spark = documents.sparkSession
    ship(spark)
    folder = shared_folder(spark, "substring")
    texts = documents.select(*row_key(documents), "text")
    occurrences = staged(
        texts.mapInArrow(lambda batches: _occurrences(batches, length, gram), _OCCURRENCES), folder, "occurrences"
    )

    anchors = (
        occurrences.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("reach").alias("least"), F.max("reach").alias("most"))
        .where("n > 1")
        .select("anchor", (F.col("least") == F.col("most")).alias("same"))
    )
    seeded = staged(occurrences.join(anchors, "anchor"), folder, "seeded")
    whole = seeded.where("same").select("key", "text_key", "a", "b")

    mixed = seeded.where("not same")
    reaches = mixed.groupBy("anchor", "reach").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "text_key", "a", "b")).alias("example")
    )
    repeated = mixed.join(reaches.where("n > 1").select("anchor", "reach"), ["anchor", "reach"], "left_semi")
    examples = (
        reaches.select("example.key", "example.text_key", F.struct("example.a", "example.b", "anchor", "n").alias("r"))
        .groupBy("key", "text_key")
        .agg(F.collect_list("r").alias("reaches"))
    )
    examples = examples.join(texts, ["key", "text_key"])
    windows = staged(
        examples.select("key", "text_key", "text", "reaches").mapInArrow(
            lambda batches: _windows(batches, length), _WINDOWS
        ),
        folder,
        "windows",
    )
    found = windows.groupBy("anchor", "window").agg(F.sum("n").alias("total")).where("total > 1")
    single = (
        windows.where("n = 1")
        .join(found.select("anchor", "window"), ["anchor", "window"], "left_semi")
        .select("key", "text_key", "a", F.col("a").alias("b"))
    )
    ranges = (
        whole.unionByName(repeated.select("key", "text_key", "a", "b"))
        .unionByName(single)
        .groupBy("key", "text_key")
        .agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("ranges"))
    )
    whole_texts = documents.select(*row_key(documents), "doc_id", "text")
    return (
        whole_texts.join(ranges, ["key", "text_key"], "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(
            lambda batches: _removed(batches, length),
            "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<begin:int,end:int>>",
        )
    )


def _occurrences(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """A row for each anchor: the first and last start of the windows that picked it."""
    for batch in batches:
        keys, text_keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for w in split_words(batch.column(2)):
            if len(w) < length:
                continue
            hashes = w.hashes()
            grams = sequence_hashes(hashes, np.arange(len(w) - gram + 1), gram)
            # the least upper half wins, then the leftmost place
            order = (mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            least = _sliding_min(order, length - gram + 1)
            starts = np.arange(len(least))
            owner = w.owner()[: len(least)]
            valid = starts + length <= w.first[1:][owner]
            starts, owner = starts[valid], owner[valid]
            if not len(starts):
                continue
            picked = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            heads = np.flatnonzero((np.diff(picked, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
            tails = np.append(heads[1:], len(starts)) - 1
            a, b, p, doc = starts[heads], starts[tails], picked[heads], owner[heads]
            reach = sequence_hashes(hashes, a, b - a + length)
            reach = mix(reach + (p - a).astype(np.uint64) * np.uint64(0x9E3779B1) + (b - a).astype(np.uint64))
            base = w.first[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[w.lo + doc]), pa.array(text_keys[w.lo + doc]),
                    pa.array((a - base).astype(np.int32)), pa.array((b - base).astype(np.int32)),
                    pa.array(signed(grams[p])), pa.array(signed(reach)),
                ],
                ["key", "text_key", "a", "b", "anchor", "reach"],
            )


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by minima over powers of two."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span : width - span + n])


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The windows of the given reaches, with their hashes."""
    for batch in batches:
        keys, text_keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        lists = batch.column(3)
        list_at = lists.offsets.to_numpy().astype(np.int64)
        fields = lists.values
        a_all, b_all, anchor_all, n_all = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        for w in split_words(batch.column(2)):
            lo, hi = list_at[w.lo], list_at[w.hi]
            if lo == hi:
                continue
            doc = np.repeat(np.arange(w.lo, w.hi), np.diff(list_at[w.lo : w.hi + 1]))
            a, b = a_all[lo:hi].astype(np.int64), b_all[lo:hi].astype(np.int64)
            count = b - a + 1
            local = gather(a, count)
            doc_of = np.repeat(doc, count)
            window = sequence_hashes(w.hashes(), local + w.first[doc_of - w.lo], length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[doc_of]), pa.array(text_keys[doc_of]), pa.array(local.astype(np.int32)),
                    pa.array(np.repeat(anchor_all[lo:hi], count)), pa.array(signed(window)),
                    pa.array(np.repeat(n_all[lo:hi], count)),
                ],
                ["key", "text_key", "a", "anchor", "window", "n"],
            )


def _removed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column(0)
        offsets, data = text_buffers(batch.column(1))
        ranges = batch.column(2)
        rows: list[list] = [[], [], [], []]
        for i in range(batch.num_rows):
            text = data[offsets[i] : offsets[i + 1]]
            w = words_of(0, 1, np.array([0, len(text)]), text)
            gone = np.zeros(len(w) + 1, np.int64)
            found = ranges[i].as_py()
            if found:
                np.add.at(gone, [r["a"] for r in found], 1)
                np.add.at(gone, [r["b"] + length for r in found], -1)
            covered = np.cumsum(gone)[:-1] > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
            kept = np.flatnonzero(~covered)
            rows[0].append(len(w))
            rows[1].append(int(covered.sum()))
            rows[2].append(_joined(text, w.begin[kept], w.end[kept]))
            rows[3].append([{"begin": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays(
            [
                doc_ids.cast(pa.int64()), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                pa.array(rows[2], pa.binary()).cast(pa.string()),
                pa.array(rows[3], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            ],
            ["doc_id", "n_words", "n_removed", "kept", "repeats"],
        )


def _joined(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    """The spans joined by one space."""
    if not len(begin):
        return b""
    lengths = end - begin + 1  # each with the byte after it, which then becomes the space
    places = gather(begin, lengths)
    body = np.append(text, np.uint8(32))[places]
    body[np.cumsum(lengths) - 1] = 32
    return body[:-1].tobytes()
