"""MinHash near-dedup by an LSH forest: sorted signature orders and their longest-common-prefix neighbours.

Texts with one and the same shingle set are one *node*.  A node's signature is TREES labels of
DEPTH minhashes each.  Every tree is the order of all nodes by one of these labels, made by a range
exchange, in which nodes that share a prefix form a *region*, and longer prefixes smaller regions.

* A node is proposed to the next nodes of each order, which are those it shares the longest prefix with.
* Depth adapts to the region: where more nodes share a prefix than the neighbours reach, its
  members are proposed to the region's hub, at that depth and at every deeper one that is still
  as crowded.  The hub is the node that lies in the largest regions of all trees taken together: in a
  group of copies of one text, each changed in another place, that is the text itself.  A group of
  any size thus costs proposals in proportion to its size, not to its square.

Proposals must agree in half of the tree's label and in length, then in most of the whole signature; what is
left is confirmed on the full shingle sets: each node's best partner first, and then whatever would still join
two components.  Nodes of one order are cut by tasks; pairs cut in one order meet in others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.components import components
from daymark.llm.shared import partitions, row_key, shared_folder, ship, staged
from daymark.llm.words import mix, shingle_sets, signed, split_words, sums_by_text

TREES, DEPTH = 12, 6
#: Following nodes of an order that a node is proposed to.
NEIGHBOURS = 4
#: Equal minhashes of a label, and of a signature, that a proposal needs; sets of a similarity of 0.8 miss
#: the first in 1.7 % of the trees, and the second once in 40,000 pairs.
LABEL_LEAST, SIGNATURE_LEAST = 3, 41
_BUFFER = 1 << 17
_DRAWN = np.random.Generator(np.random.PCG64(20260131)).integers(0, 2**64, (3, TREES * DEPTH), dtype=np.uint64)
_XOR, _TIMES = _DRAWN[0], _DRAWN[1] | np.uint64(1)
_OTHER = np.uint64(0x9E3779B97F4A7C15)

_SET = "key long, text_key long, doc_id long, name1 long, name2 long, n long, signature binary"
_ROW = "tree int, label binary, node long, n long"


def near_copies(documents: DataFrame, percent: int = 80, gram: int = 4) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id``, ``component_id``, ``kept`` and the row's ``key``, ``text_key``.

    A-Z count as a-z.  Rows link where ``100 * |intersection| >= percent * |union|`` of their shingle
    sets; ``class_id`` is the least doc_id with the same set, ``component_id`` the least doc_id reachable
    by links that were found, and ``kept`` tells whether that is the row's own.  A text with fewer than
    ``gram`` words has its whole sequence as its one shingle.  Null and empty texts, and texts without
    words, have no shingles, link with nothing and are kept.  Repeated rows are one class and share
    their fate.  A null doc_id is never the least where there is another.  An empty table gives no rows.
    """
    spark = documents.sparkSession
    ship(spark)
    folder = shared_folder(spark, "forest")
    texts = documents.select(*row_key(documents), F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = staged(texts.mapInArrow(lambda batches: _sets(batches, gram), _SET), folder, "sets")
    nodes = sets.where("n > 0").groupBy("name1", "name2").agg(
        F.min(F.struct("key", "text_key")).alias("example"), F.min("doc_id").alias("class_id"), F.max("n").alias("n"),
        F.first("signature").alias("signature"),
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), folder, "nodes")

    labels = nodes.select("node", "n", "signature").mapInArrow(_labels, _ROW)
    crowd = _in_order(labels).mapInArrow(_crowds, "node long, crowd long").groupBy("node").agg(F.sum("crowd").alias("crowd"))
    crowd = staged(crowd, folder, "crowds")
    rows = nodes.select("node", "n", "signature").join(crowd, "node").mapInArrow(_labels, f"{_ROW}, crowd long")
    proposed = _in_order(rows).mapInArrow(lambda batches: _proposed(batches, percent), "a long, b long").distinct()
    signatures = [nodes.select(F.col("node").alias(x), F.col("signature").alias(f"signature_{x}")) for x in "ab"]
    likely = proposed.join(signatures[0], "a").join(signatures[1], "b").select("a", "b", "signature_a", "signature_b")
    likely = staged(likely.mapInArrow(_likely, "a long, b long, agree int"), folder, "likely")

    ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    examples = nodes.join(ends, "node", "left_semi").select("node", "example.key", "example.text_key")
    wanted = texts.select("key", "text_key", "text").join(examples, ["key", "text_key"]).dropDuplicates(["node"]).select("node", "text")
    wanted = staged(wanted, folder, "texts")

    best = [
        likely.groupBy(x).agg(F.max(F.struct("agree", y)).alias("best")).select(F.col(x), F.col(f"best.{y}").alias(y)).select("a", "b")
        for x, y in ("ab", "ba")
    ]
    tried = _confirmed(best[0].unionByName(best[1]).distinct(), wanted, percent, gram, folder, "first")
    roots = components(tried.where("similar"), folder, "roots_1")
    places = [roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab"]
    rest = likely.join(tried, ["a", "b"], "left_anti").join(places[0], "a", "left").join(places[1], "b", "left")
    rest = rest.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    more = _confirmed(rest, wanted, percent, gram, folder, "rest")
    if more.where("similar").take(1):
        roots = components(tried.unionByName(more).where("similar"), folder, "roots_2")

    placed = nodes.join(roots, "node", "left").select("name1", "name2", "class_id", F.coalesce("root", "node").alias("root"))
    placed = staged(placed, folder, "placed")
    least = staged(placed.groupBy("root").agg(F.min("class_id").alias("component_id")), folder, "least")
    answer = placed.join(least, "root").select("name1", "name2", "class_id", "component_id")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sets.drop("signature").join(answer, ["name1", "name2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        component_id.alias("component_id"), component_id.eqNullSafe(F.col("doc_id")).alias("kept"), "key", "text_key",
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """The orders of all trees, one after the other; equal labels may be cut anywhere between their nodes."""
    return rows.repartitionByRange(partitions(rows.sparkSession), "tree", "label", "node").sortWithinPartitions("tree", "label", "node")


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """TREES * DEPTH minhashes of each set, 32 bits each; zeros for an empty set."""
    out = np.zeros((len(first) - 1, TREES * DEPTH), np.uint32)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for k in range(TREES * DEPTH):
            drawn = (hashes ^ _XOR[k]) * _TIMES[k]
            drawn ^= drawn >> np.uint64(32)
            drawn *= _TIMES[k - 1]
            out[some, k] = np.minimum.reduceat(drawn, first[some]) >> np.uint64(32)
    return out


def _sets(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Each text's set: two names that together tell it apart, its size and its signature."""
    for batch in batches:
        for w in split_words(batch.column(3), lower=True):
            hashes, first = shingle_sets(w, gram)
            sizes = np.diff(first)
            names = [mix(sums_by_text(mix(hashes ^ salt), first) + sizes.astype(np.uint64)) for salt in (np.uint64(0), _OTHER)]
            rows = batch.slice(w.lo, w.texts)
            signature = signatures(hashes, first).astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], *(pa.array(signed(x)) for x in names), pa.array(sizes), _binary(signature)],
                ["key", "text_key", "doc_id", "name1", "name2", "n", "signature"],
            )


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of numbers as one binary value."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    """What ``_binary`` wrote."""
    if not len(column):
        return np.zeros((0, width), ">u4")
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, ">u4", len(column) * width, start).reshape(len(column), width)


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree, with the tree's part of the signature."""
    for batch in batches:
        labels = _numbers(batch.column(2), TREES * DEPTH).reshape(-1, TREES, DEPTH)
        others = [(f.name, batch.column(i)) for i, f in enumerate(batch.schema) if f.name not in ("node", "n", "signature")]
        for tree in range(TREES):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(labels), tree, np.int32)), _binary(labels[:, tree]), *batch.columns[:2], *(c for _, c in others)],
                ["tree", "label", "node", "n", *(name for name, _ in others)],
            )


def _buffers(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """A task's rows in order, some at a time: how long a prefix each shares with the row before it, labels, other columns.

    Every buffer begins with the last ``overlap`` rows of the one before.
    """
    held: list[list[np.ndarray]] = []

    def flush() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        tree, labels, *others = (np.concatenate(x) for x in zip(*held))
        same = np.logical_and.accumulate(labels[1:] == labels[:-1], axis=1) & (tree[1:] == tree[:-1])[:, None]
        shared = np.concatenate([[0], same.sum(axis=1)])
        held[:] = [[x[len(x) - overlap :] for x in (tree, labels, *others)]] if overlap else []
        return shared, labels, others

    fresh = 0
    for batch in batches:
        if batch.num_rows:
            others = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
            held.append([batch.column(0).to_numpy(zero_copy_only=False), _numbers(batch.column(1), DEPTH), *others])
            fresh += batch.num_rows
        if fresh >= _BUFFER:
            yield flush()
            fresh = 0
    if fresh:
        yield flush()


def _regions(shared: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The region of each row at a depth, and the sizes of the regions."""
    region = np.cumsum(np.concatenate([[False], shared[1:] < depth]))
    return region, np.bincount(region)


def _crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many nodes share prefixes with each node, summed over depths."""
    for shared, _, (node, _) in _buffers(batches, 0):
        crowd = np.zeros(len(node), np.int64)
        for depth in range(1, DEPTH + 1):
            region, sizes = _regions(shared, depth)
            crowd += sizes[region]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(crowd)], ["node", "crowd"])


def _proposed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours, and of nodes and hubs, that may be similar."""
    for shared, labels, (node, n, crowd) in _buffers(batches, NEIGHBOURS):
        pairs = []
        for step in range(1, min(NEIGHBOURS, len(node) - 1) + 1):
            near = np.minimum.reduce([shared[step - k : len(shared) - k] for k in range(step)]) > 0
            at = np.flatnonzero(near)
            pairs.append((at, at + step))
        for depth in range(1, DEPTH + 1):
            region, sizes = _regions(shared, depth)
            order = np.lexsort((node, -crowd, region))
            hub = order[np.cumsum(sizes) - sizes]
            at = np.flatnonzero(sizes[region] > NEIGHBOURS + 1)
            pairs.append((at, hub[region[at]]))
        one, other = (np.concatenate(x) for x in zip(*pairs))
        alike = (labels[one] == labels[other]).sum(axis=1) >= LABEL_LEAST
        lengths = 100 * np.minimum(n[one], n[other]) >= percent * np.maximum(n[one], n[other])
        one, other = (node[x[alike & lengths]] for x in (one, other))
        found = np.unique(np.stack([np.minimum(one, other), np.maximum(one, other)], axis=1), axis=0)
        found = found[found[:, 0] < found[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures agree enough."""
    for batch in batches:
        one, other = (_numbers(batch.column(k), TREES * DEPTH) for k in (2, 3))
        agree = (one == other).sum(axis=1)
        keep = pa.array(agree >= SIGNATURE_LEAST)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(agree.astype(np.int32)).filter(keep)], ["a", "b", "agree"]
        )


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, gram: int, folder: str, name: str) -> DataFrame:
    """``a``, ``b``, ``similar`` of each pair, from the whole sets of its texts."""
    one, other = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return staged(both.mapInArrow(lambda batches: _intersected(batches, percent, gram), "a long, b long, similar boolean"), folder, name)


def _intersected(batches: Iterator[pa.RecordBatch], percent: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            rows = batch.slice(lo, 64)
            sets: list[list[np.ndarray]] = [[], []]
            for k in (0, 1):
                for w in split_words(rows.column(2 + k), lower=True):
                    hashes, first = shingle_sets(w, gram)
                    sets[k] += np.split(hashes, first[1:-1])
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets)]
            similar = [100 * c >= percent * (len(x) + len(y) - c) for c, x, y in zip(common, *sets)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(similar, pa.bool_())], ["a", "b", "similar"])
