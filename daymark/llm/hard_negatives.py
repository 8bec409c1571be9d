"""Hard-negative mining by Kronecker-packed products: exact integer scores of many rows at a time.

The components of up to ``PACKED`` rows in one place of the vector are biased to be no less than 0
and laid side by side as fields of one wide integer.  Multiplying that integer by an anchor's
component multiplies every field; the sum over the places holds every row's inner product in its
field, from which the biases are taken off again.  Fields are wide enough for the largest possible
sum, whatever the components, so that nothing carries over and scores are exact.

Anchors and rows meet in a grid of cells, each a bounded block of anchors and a bounded block of
rows; a cell gives each anchor's best rows only, and these are ranked over all cells.  The grid is
gone through twice: for the positives, and then, with their scores known, for the negatives.
"""

from __future__ import annotations

import math
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymark.llm.shared import partitions, shared_folder, ship, staged

#: Rows of one wide integer, and factor of the components.
PACKED, SCALE = 1024, 256
#: Anchors and rows of a cell, about; there are cells of LEAST rows where more tasks are wanted.
ANCHORS, ROWS, LEAST = 4096, 16384, 1024
_MOST = 2**63 - 1
_FOUND = "row_id long, wanted long, vec_id long, score long"


def mine_hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100)
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``label``, ``vector`` and ``is_anchor``.  Rows with a null label, a
    null vector, or any null or non-finite component take no part.  A score is the inner product
    of ``floor(256 * component)``; higher ones come first, ties by the smaller vec_id, nulls last.
    An anchor's positives are its best ``positives`` other rows of its label; for each of them the
    best ``negatives`` rows of other labels are given whose score is within ``percent`` of the positive's.

    Equal rows are rows of their own: they are positives of one another, each is an anchor, and
    its results are given once for each.  A null ``is_anchor`` is false.  Shorter vectors count as
    ended by zeros.  Scores beyond a long count as the nearest long.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = shared_folder(spark, "negatives")
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "vector",
        F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
    )
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~broken)
    rows = rows.groupBy("vec_id", "label", "vector", "is_anchor").agg(F.count("*").alias("copies"))
    rows = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), folder, "rows")
    anchors = staged(rows.where("is_anchor"), folder, "anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    across = max(1, -(-n_anchors // ANCHORS))
    along = max(1, -(-n_rows // ROWS), min(partitions(spark), -(-n_rows // LEAST)))

    no_scores = anchors.withColumn("scores", F.array().cast("array<long>"))
    first = _best(rows, no_scores, across, along, positives, percent).drop("wanted")
    first = _ranked(first, ["row_id"], positives).select("row_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("wanted"))
    first = staged(first, folder, "positives")
    scores = first.groupBy("row_id").agg(F.sort_array(F.collect_set("wanted")).alias("scores"))
    found = _ranked(_best(rows, anchors.join(scores, "row_id"), across, along, negatives, percent), ["row_id", "wanted"], negatives)

    named = anchors.select("row_id", F.col("vec_id").alias("anchor_id"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return first.join(found, ["row_id", "wanted"]).join(named, "row_id").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("wanted").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def _best(rows: DataFrame, anchors: DataFrame, across: int, along: int, most: int, percent: tuple[int, int]) -> DataFrame:
    """Each cell's best rows for each anchor, by ``wanted`` score.

    Anchors without scores want the best rows of their own label, others those of other labels near each score.
    Every anchor goes to ``along`` cells and every row to ``across`` cells.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")
    left = rows.select("row_id", "vec_id", "label", "vector", "copies", place(along).alias("h"), every(across).alias("g"))
    right = anchors.select("row_id", "label", "vector", "scores", place(across).alias("g"), every(along).alias("h"))

    def cell(candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        return _cell(candidates, wanted, most, percent)

    return left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(cell, _FOUND)


def _cell(rows: pa.Table, anchors: pa.Table, most: int, percent: tuple[int, int]) -> pa.Table:
    rows = rows.sort_by([("vec_id", "ascending")])  # nulls come last
    vec_ids, copies = rows["vec_id"].combine_chunks(), np.asarray(rows["copies"])
    width = max([0, *(pc.max(pc.list_value_length(t["vector"])).as_py() or 0 for t in (rows, anchors))])
    labels = pa.concat_arrays([t["label"].combine_chunks() for t in (rows, anchors)]).dictionary_encode().indices
    row_label, anchor_label = np.split(np.asarray(labels), [rows.num_rows])
    values, wide = _integers(anchors["vector"], width), _integers(rows["vector"], width)
    place = {row_id: i for i, row_id in enumerate(rows["row_id"].to_pylist())}
    own = [place.get(row_id, -1) for row_id in anchors["row_id"].to_pylist()]
    scores_wanted = anchors["scores"].to_pylist()

    held: list[list[tuple]] = [[] for _ in own]  # for each anchor: what is wanted, places, scores
    for lo in range(0, rows.num_rows, PACKED):
        here = slice(lo, lo + PACKED)
        block = Packed(wide[here], values)
        for a, wants in enumerate(scores_wanted):
            scores, number = block.scores(a), copies[here]
            if not wants:
                same = row_label[here] == anchor_label[a]
                if lo <= own[a] < lo + len(number):  # the anchor is not one of its own positives, its copies are
                    number = number.copy()
                    number[own[a] - lo] -= 1
                    same &= number > 0
                _hold(held[a], None, scores, np.flatnonzero(same), number, lo, most)
                continue
            other = row_label[here] != anchor_label[a]
            for score in wants:
                near = other & (scores >= -(-percent[0] * score // 100)) & (scores <= percent[1] * score // 100)
                _hold(held[a], score, scores, np.flatnonzero(near), number, lo, most)

    out: list[tuple] = []
    for row_id, parts in zip(anchors["row_id"].to_pylist(), held):
        for want in dict.fromkeys(part[0] for part in parts):
            at, scores = (np.concatenate([part[k] for part in parts if part[0] == want]) for k in (1, 2))
            best = np.argsort(-scores, kind="stable")[:most]
            out += [(row_id, want, int(i), int(x)) for i, x in zip(at[best], scores[best])]
    columns = list(zip(*out)) or [()] * 4
    return pa.table(
        [
            pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
            vec_ids.take(pa.array(columns[2], pa.int64())).cast(pa.int64()), pa.array(columns[3], pa.int64()),
        ],
        ["row_id", "wanted", "vec_id", "score"],
    )


def _hold(held: list, want, scores: np.ndarray, usable: np.ndarray, copies: np.ndarray, lo: int, most: int) -> None:
    """Keep the ``most`` best of the usable rows, first ones among equals, with their copies."""
    if not len(usable):
        return
    if len(usable) > 4 * most:
        worst = np.partition(scores[usable], len(usable) - most)[len(usable) - most]
        usable = usable[scores[usable] >= worst]
    best = usable[np.argsort(-scores[usable], kind="stable")[:most]]
    best = np.repeat(best, np.minimum(copies[best], most))[:most]
    held.append((want, best + lo, scores[best]))


def _integers(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """``floor(256 * x)`` of every component, one vector a row; Python's integers where they are too large for a long."""
    lengths = np.asarray(pc.list_value_length(column).combine_chunks()).astype(np.int64)
    flat = np.asarray(pc.list_flatten(column).combine_chunks(), np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    if (np.abs(scaled) < 2.0**61).all():
        whole = scaled.astype(np.int64)
    else:
        whole = np.array([int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in flat.tolist()], object)
    out = np.zeros((len(lengths), width), whole.dtype)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = whole
    return out


class Packed:
    """The components of some rows, one wide integer for each place of the vector, and their products with anchors."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        self.n, self.width = rows.shape
        if not rows.size or not anchors.size:
            self.width = 0
            return
        self.least, self.anchor_least = int(rows.min()), int(anchors.min())
        rows = rows - self.least
        most = self.width * max(1, int(rows.max())) * max(1, int(anchors.max()) - self.anchor_least)
        self.bits = 32 if most < 2**32 else -(-most.bit_length() // 64) * 64
        size = self.bits // 8
        if size <= 8:
            fields = rows.T.astype(f"<u{size}")
            self.places = [int.from_bytes(place.tobytes(), "little") for place in fields]
        else:
            self.places = [int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in place), "little") for place in rows.T]
        largest = [max(abs(int(x.min())), abs(int(x.max()))) for x in (rows + self.least, anchors)]
        self.fits = self.width * largest[0] * largest[1] <= _MOST
        self.row_sums = rows.astype(np.uint64).sum(axis=1) if self.fits else [sum(map(int, row)) for row in rows]
        self.biased = (anchors - self.anchor_least).tolist()
        self.anchor_sums = [sum(map(int, row)) for row in anchors]

    def scores(self, anchor: int) -> np.ndarray:
        """The inner product of each row with an anchor."""
        if not self.width:
            return np.zeros(self.n, np.int64)
        total = sum(map(mul, self.biased[anchor], self.places)).to_bytes(self.n * self.bits // 8, "little")
        rest = self.least * self.anchor_sums[anchor]
        if self.fits:  # the score is right modulo 2**64, and so is what the biases added
            word = min(self.bits, 64)
            fields = np.frombuffer(total, f"<u{word // 8}").reshape(self.n, -1)[:, 0].astype(np.uint64)
            fields += self.row_sums * np.uint64(self.anchor_least % 2**64) + np.uint64(rest % 2**64)
            return fields.view(np.int64)
        size = self.bits // 8
        fields = (int.from_bytes(total[k : k + size], "little") for k in range(0, len(total), size))
        exact = (x + self.anchor_least * y + rest for x, y in zip(fields, self.row_sums))
        return np.array([max(-_MOST, min(_MOST, x)) for x in exact], np.int64)
