"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import ship, staged

#: Links that a task contracts at a time.
_HELD = 500_000


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (``a``, ``b``); the root is its component's least node.

    Links are contracted in blocks of up to half a million first; then each star step points the neighbours of a node to the least of them, so a component ends as
    one star; the number of steps grows with the logarithm of its size.  Links stay in tables
    of the shared folder; the driver only learns whether all components are stars.
    """
    ship(links.sparkSession)
    links = links.where("a <> b").select("a", "b")
    blocks = max(1, -(-links.count() // _HELD))  # each task contracts a block of links by itself
    edges = staged(links.coalesce(blocks).mapInArrow(_stars, "u long, v long").distinct(), folder, f"{name}_0")
    step = 0
    while _unfinished(edges):
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, folder, f"{name}_{step}_large")
        pointed = both.join(large, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pointed = staged(pointed.distinct(), folder, f"{name}_{step}_pointed")
        small = pointed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        to_least = pointed.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small.select("u", F.col("m").alias("v"))
        edges = staged(to_least.unionByName(own).where("u <> v").distinct(), folder, f"{name}_{step}")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a task's own links, each as a star around its least node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > _HELD:
            yield _pointers(parent, root)
            parent.clear()
    if parent:
        yield _pointers(parent, root)


def _pointers(parent: dict[int, int], root) -> pa.RecordBatch:
    pairs = [(x, root(x)) for x in list(parent)]
    pairs = [(x, y) for x, y in pairs if x != y]
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node points to two others, or to one and is pointed to."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return bool(ends.where("out > 1 or (out = 1 and into = 1)").take(1))


def _least(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """The least of each node and its neighbours; a table of its own, so that the join with it can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return staged(least, folder, name)
