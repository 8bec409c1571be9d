"""N-gram Jaccard join: rare-first prefix filtering, then one verification per pair.

Texts with one and the same shingle set are one *node*; what follows is about distinct sets.

1. Every node's shingles are put in one global order, rare ones first.  Two sets that are
   similar enough share a shingle among the first ``n - ceil(t n) + 1`` of each (its prefix).
   Rarity is counted over all documents in hashed counters, about one for every eight shingles
   and 2**COUNTER_BITS at most, which tasks map into memory.  The counters only order the
   shingles; where they are too few for a corpus, more candidates are proposed, with the same result.
2. Prefix shingles meet in shards, as packed arrays.  Of the nodes that share one, each is
   proposed to its length band's hub, the node with the least rare shingles before it, and to
   its neighbour in length, not to every other.
   Proposals pass the length and positional filters here and the suffix filter before
   their sets are intersected.
3. Verified links make components.  A shingle whose nodes are by then all in one component
   has no link left to find that would change a component.  For all others, nodes of
   different components are proposed to further hubs.  What is then left is joined exactly: of a similar pair the
   smaller set has its first shared shingle early enough for most of it to come after (it is *strong*
   there).  So nobody meets where none is strong; else those outside a shingle's largest component
   meet the others there, and a group of copies is never paired with itself.

A pair is verified once.  Groups of copies of any size cost links in proportion to their size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymark.llm.components import components
from daymark.llm.packed import from_planes, planes
from daymark.llm.shared import partitions, remove, row_key, send_files, shared_folder, ship, staged, write_file
from daymark.llm.words import mix, shingle_sets, signed, split_words, sums_by_text

#: One-byte shingle counters, at least and at most, as powers of two; they lie in SEGMENTS files.
COUNTER_BITS = (18, 28)
SEGMENTS = 32
#: Hash ranges of the suffix filter, a power of two.
SUFFIX_PARTS = 128
#: Turns with drawn hubs after the first proposals; more of them leave fewer pairs for the exact rest.
HUB_TURNS = 1
_FLUSH = 2_000_000


def similar_groups(documents: DataFrame, percent: int = 75, gram: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id``, ``component_id``, ``component`` and the row's ``key``, ``text_key``.

    A-Z count as a-z.  Two rows link where ``100 * |intersection| >= percent * |union|`` of their
    shingle sets; ``class_id`` is the least doc_id with the same set, ``component_id`` the least
    doc_id reachable by links, and ``component`` a name of the component that needs no ids.  Texts without words have no shingles and link with nothing, not even
    with each other.  Repeated rows are one class.  A null doc_id is never the least where
    there is another.
    """
    spark = documents.sparkSession
    ship(spark)
    folder = shared_folder(spark, "jaccard")
    texts = documents.select(*row_key(documents), "doc_id", "text")

    sets = staged(
        texts.mapInArrow(
            lambda batches: _sets(batches, gram), "key long, text_key long, doc_id long, node long, n long, parts binary"
        ),
        folder, "sets",
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counters = _count_shingles(texts, gram, min(max(int(total // 8).bit_length(), COUNTER_BITS[0]), COUNTER_BITS[1]), folder)
    nodes = staged(
        sets.where("n > 0").groupBy("node").agg(
            F.min(F.struct("key", "text_key")).alias("example"), F.min("doc_id").alias("class_id"),
            F.first("parts").alias("parts"),
        ),
        folder, "nodes",
    )

    shards = partitions(spark)
    met = staged(
        texts.select("text")
        .mapInArrow(lambda batches: _prefixes(batches, gram, percent, shards, counters), "shard int, blob binary")
        .repartitionById(shards, F.col("shard"))
        .mapInArrow(lambda batches: _meet(batches, percent), "kind int, a long, b long, n int, pos int, c long"),
        folder, "met",
    )
    postings = met.where("kind = 0").select(F.col("a").alias("token"), F.col("b").alias("node"), "n", "pos")

    # each node's likeliest partners first: most need no other
    votes = met.where("kind = 1").groupBy("a", "b").agg(F.sum("c").alias("c"))
    best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
    first = votes.withColumn("place", F.row_number().over(best)).where("place <= 2")
    first = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = _verified(first, nodes, texts, percent, gram, folder, "links_0")
    roots = components(tried.where("similar"), folder, "roots_0")
    left, pairs_left = _open(postings, roots, percent, folder, "open_0")
    turn = 0
    while pairs_left:
        turn += 1
        # hubs first while shingles join many nodes; in the end whatever is still possible
        last = turn > HUB_TURNS or pairs_left <= 8 * left.count()
        pairs = _rest(left, percent) if last else _to_hubs(left, turn, percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        new = _verified(pairs, nodes, texts, percent, gram, folder, f"links_{turn}")
        tried = tried.unionByName(new)
        if new.where("similar").take(1):
            roots = components(tried.where("similar"), folder, f"roots_{turn}")
        if last:
            break
        left, pairs_left = _open(left.select("token", "node", "n", "pos"), roots, percent, folder, f"open_{turn}")

    placed = nodes.join(roots, "node", "left").select(
        "node", "class_id", F.coalesce("root", "node").alias("root")
    )
    placed = staged(placed, folder, "placed")
    least = staged(placed.groupBy("root").agg(F.min("class_id").alias("component_id")), folder, "least")
    answer = staged(placed.join(least, "root").select("node", "class_id", "component_id", "root"), folder, "answer")
    return sets.join(answer, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"), F.col("root").alias("component"), "key", "text_key",
    )


def _node_ids(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, from sums of its members that do not depend on order."""
    sizes = np.diff(first).astype(np.uint64)
    return mix(sums_by_text(mix(hashes), first) + mix(sums_by_text(hashes * hashes, first) + sizes))


class Counters(NamedTuple):
    """The power of two of the counters, and the files of their segments."""

    bits: int
    files: tuple[tuple[int, str], ...] = ()

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """How often each shingle occurs: counts to 127, then four steps to a doubling."""
        files = _open_counters(self)
        bucket = self.bucket(hashes)
        shift = self.bits - (SEGMENTS - 1).bit_length()
        segment = bucket >> shift
        out = np.zeros(len(hashes), np.uint8)
        for k, file in enumerate(files):
            rows = np.flatnonzero(segment == k)
            if file is not None and len(rows):
                out[rows] = file[bucket[rows] - (k << shift)]
        return out


_MOST = np.uint32(2**32 - 1)


def _steps(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte each, in order: exact to 127, then four steps to a doubling, so that hot shingles differ too."""
    return np.where(counts < 128, counts, 128 + 4 * np.log2(np.maximum(counts, 128) / 128.0)).astype(np.uint8)


@lru_cache(maxsize=1)
def _open_counters(counters: Counters) -> list[np.ndarray | None]:
    found: list[np.ndarray | None] = [None] * SEGMENTS
    for segment, name in counters.files:
        found[segment] = np.memmap(SparkFiles.get(name), np.uint8, "r")
    return found


def _sets(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Each text's set: its name, size and members by hash range."""
    for batch in batches:
        for w in split_words(batch.column(3), lower=True):
            hashes, first = shingle_sets(w, gram)
            rows = batch.slice(w.lo, w.texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns[:2], rows.column(2).cast(pa.int64()), pa.array(signed(_node_ids(hashes, first))),
                    pa.array(np.diff(first)), pa.array(_parts(hashes, first), pa.binary()),
                ],
                ["key", "text_key", "doc_id", "node", "n", "parts"],
            )


def _count_shingles(texts: DataFrame, gram: int, bits: int, folder: str) -> Counters:
    """Count the shingles of all texts by bucket and send the counters to all machines."""
    counters = Counters(bits)
    uri = f"{folder}/counters"
    size = (1 << bits) // SEGMENTS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for w in split_words(batch.column(0), lower=True):
                held.append(counters.bucket(shingle_sets(w, gram)[0]))
                if sum(map(len, held)) > _FLUSH:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        buckets, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(buckets, np.arange(SEGMENTS + 1) * size)
        blobs = [
            planes(np.diff(buckets[x:y], prepend=k * size).astype(np.uint32)) + planes(counts[x:y].astype(np.uint32))
            for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]))
        ]
        return pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(blobs, pa.binary())], ["segment", "blob"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                blob = memoryview(blob.as_buffer())
                n = len(blob) // 8
                place = np.cumsum(from_planes(blob, n, np.uint32), dtype=np.int64)
                counts = sums.setdefault(segment, np.zeros(size, np.uint32))
                counts[place] += np.minimum(from_planes(blob[4 * n :], n, np.uint32), _MOST - counts[place])
        names = [f"counters-{uuid.uuid4().hex}.u8" for _ in sums]
        for name, counts in zip(names, sums.values()):
            write_file(f"{uri}/{name}", _steps(counts).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(names, pa.string())], ["segment", "name"])

    blobs = texts.select("text").mapInArrow(counted, "segment int, blob binary")
    made = blobs.repartitionById(SEGMENTS, F.col("segment")).mapInArrow(added, "segment int, name string").collect()
    send_files(texts.sparkSession, [f"{uri}/{row.name}" for row in made])
    return counters._replace(files=tuple((row.segment, row.name) for row in made))


def _prefixes(
    batches: Iterator[pa.RecordBatch], gram: int, percent: int, shards: int, counters: Counters
) -> Iterator[pa.RecordBatch]:
    """Packed prefix shingles for each shard."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        for w in split_words(batch.column(0), lower=True):
            hashes, first = shingle_sets(w, gram)
            sizes = np.diff(first)
            ids = _node_ids(hashes, first)
            _, chosen = np.unique(ids, return_index=True)  # one text for each set
            chosen = chosen[sizes[chosen] > 0]
            owner = np.repeat(np.arange(w.texts), sizes)
            use = np.zeros(w.texts, bool)
            use[chosen] = True
            mine = use[owner]
            hashes, owner = hashes[mine], owner[mine]
            order = np.lexsort((hashes, counters.of(hashes), owner))  # rare first
            hashes, owner = hashes[order], owner[order]
            starts = np.searchsorted(owner, owner, "left")
            pos = np.arange(len(owner)) - starts
            n = sizes[owner]
            keep = pos < n + (-percent * n) // 100 + 1
            held.append((hashes[keep], ids[owner[keep]], n[keep], pos[keep]))
            size += int(keep.sum())
            if size >= _FLUSH:
                yield from _packed(held, shards)
                held, size = [], 0
    if held:
        yield from _packed(held, shards)


def _packed(held: list[tuple[np.ndarray, ...]], shards: int) -> Iterator[pa.RecordBatch]:
    token, node, n, pos = (np.concatenate(x) for x in zip(*held))
    shard = (mix(token) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((token, shard))
    token, node, n, pos, shard = (x[order] for x in (token, node, n, pos, shard))
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    numbers, blobs = [], []
    for k in range(shards):
        part = slice(cuts[k], cuts[k + 1])
        if cuts[k] == cuts[k + 1]:
            continue
        ids, at, index = np.unique(node[part], return_index=True, return_inverse=True)
        head = np.array([len(ids), cuts[k + 1] - cuts[k]], np.uint64)
        numbers.append(k)
        blobs.append(
            b"".join(
                (
                    head.tobytes(), ids.tobytes(), n[part][at].astype(np.uint32).tobytes(),
                    planes(np.diff(token[part], prepend=np.uint64(0))), planes(index.astype(np.uint32)),
                    planes(pos[part].astype(np.uint32)),
                )
            )
        )
    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _unpacked(blob: memoryview) -> tuple[np.ndarray, ...]:
    n_ids, count = (int(x) for x in np.frombuffer(blob, np.uint64, 2))
    ids = np.frombuffer(blob, np.uint64, n_ids, 16)
    sizes = np.frombuffer(blob, np.uint32, n_ids, 16 + 8 * n_ids)
    at = 16 + 12 * n_ids
    token = np.cumsum(from_planes(blob[at:], count, np.uint64), dtype=np.uint64)
    index = from_planes(blob[at + 8 * count :], count, np.uint32)
    pos = from_planes(blob[at + 12 * count :], count, np.uint32)
    return token, ids[index], sizes[index].astype(np.int64), pos.astype(np.int64)


def _meet(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """What meets at the shingles of a shard: postings of shared shingles, and proposals."""
    parts = [
        _unpacked(memoryview(blob.as_buffer())) for batch in batches for blob in batch.column(batch.schema.get_field_index("blob"))
    ]
    if not parts:
        return
    token, node, n, pos = (np.concatenate(x) for x in zip(*parts))
    del parts
    # a shingle of one node only meets nobody: drop these before the full sort
    order = np.argsort(token, kind="stable")
    token, node, n, pos = token[order], node[order], n[order], pos[order]
    again = np.zeros(len(token), bool)
    again[1:] = token[1:] == token[:-1]
    again[:-1] |= again[1:]
    token, node, n, pos = token[again], node[again], n[again], pos[again]
    order = np.lexsort((node, n, token))
    token, node, n, pos = token[order], node[order], n[order], pos[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, n, pos = token[new], node[new], n[new], pos[new]
    run = np.cumsum(np.diff(token, prepend=~token[:1]) != 0) - 1
    several = np.zeros(0, bool)
    if len(run):
        several = (np.bincount(run) > 1)[run] & (np.bincount(run, _strong(n, pos, percent)) > 0)[run]
    token, node, n, pos, run = token[several], node[several], n[several], pos[several], run[several]
    if not len(token):
        return
    for lo in range(0, len(token), 100_000):
        part = slice(lo, lo + 100_000)
        yield _met(0, token[part], node[part], n[part], pos[part], np.ones(len(token[part]), np.int64))

    # the neighbour in length, and the hub of the length band
    i = np.flatnonzero(run[1:] == run[:-1]) + 1
    band = _band(n)
    order = np.lexsort((mix(node), pos, band, run))  # the hub has least rare shingles before this one: a group's original
    head = np.ones(len(order), bool)
    head[1:] = (run[order][1:] != run[order][:-1]) | (band[order][1:] != band[order][:-1])
    hub = np.empty(len(order), np.int64)
    hub[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    a, b = np.concatenate([i, np.arange(len(hub))]), np.concatenate([i - 1, hub])
    ok = (node[a] != node[b]) & _filters(n[a], n[b], pos[a], pos[b], percent)
    a, b = a[ok], b[ok]
    if not len(a):
        return
    pairs = np.stack([node[a], node[b]], axis=1)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    head = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
    votes = np.diff(np.append(head, len(pairs)))
    pairs = pairs[head]
    zero = np.zeros(len(pairs), np.int64)
    yield _met(1, pairs[:, 0], pairs[:, 1], zero, zero, votes)


def _met(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, pos: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(a), kind, np.int32)), pa.array(signed(a)), pa.array(signed(b)),
            pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(c.astype(np.int64)),
        ],
        ["kind", "a", "b", "n", "pos", "c"],
    )


def _band(n: np.ndarray) -> np.ndarray:
    """Lengths in bands narrow enough for most pairs within one to pass the length filter."""
    return np.floor(np.log(n) / np.log(1.2)).astype(np.int64)


def _needed(n, m, percent: int):
    """The least intersection of sets of n and m members that are similar enough, rounded up."""
    return -((-percent * (n + m)) // (100 + percent))


def _filters(n, m, pos_n, pos_m, percent: int):
    """Length filter, and positional filter for sets whose first shared shingle is at ``pos_n`` and ``pos_m``.

    Sets that are similar enough pass at their first shared shingle: all the others come after it in both.
    """
    short, long_ = np.minimum(n, m), np.maximum(n, m)
    most = np.minimum(n - pos_n, m - pos_m)
    return (100 * short >= percent * long_) & (most >= _needed(n, m, percent))


def _strong(n, pos, percent: int):
    """Whether a set can be the smaller one of a similar pair whose first shared shingle is at ``pos``.

    All that such a pair shares comes from there on, and is ``2 percent / (100 + percent)`` of the smaller set at least.
    Of a similar pair one is strong, so sets that share a shingle are never paired where none is.
    """
    return (100 + percent) * (n - pos) >= 2 * percent * n


def _sql_filters(percent: int):
    """The same two filters over columns n1, n2, pos1, pos2."""
    most = F.least(F.expr("n1 - pos1"), F.expr("n2 - pos2"))
    return (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & (
        (100 + percent) * most >= percent * (F.col("n1") + F.col("n2"))
    )


def _open(postings: DataFrame, roots: DataFrame, percent: int, folder: str, name: str) -> tuple[DataFrame, int]:
    """The postings of shingles that nodes of several components share, and how many pairs of them are to be looked at."""
    placed = staged(
        postings.join(roots, "node", "left").select("token", "node", "n", "pos", F.coalesce("root", "node").alias("root")),
        folder, f"{name}_placed",
    )
    strong = F.count_if(_strong(F.col("n").cast("long"), F.col("pos"), percent))
    parts = placed.groupBy("token", "root").agg(F.count("*").alias("k"), strong.alias("s"))
    spread = parts.groupBy("token").agg(
        F.max(F.struct("k", "root")).alias("main"), F.sum("k").cast("double").alias("k"), F.sum("s").alias("s"), F.count("*").alias("roots")
    )
    spread = staged(spread.where("roots > 1 and s > 0").select("token", "main", "k"), folder, f"{name}_tokens")
    pairs = spread.agg(F.sum(F.expr("(k - main.k) * k"))).first()[0] or 0
    open_ = placed.join(spread.select("token", F.col("main.root").alias("main")), "token")
    left = staged(open_.withColumn("minor", F.col("root") != F.col("main")).drop("main"), folder, name)
    remove(folder, f"{name}_placed", f"{name}_tokens", spark=left.sparkSession)
    return left, int(pairs)


def _to_hubs(left: DataFrame, turn: int, percent: int) -> DataFrame:
    """Nodes and the hub that this turn draws for each shingle and length band, of another component."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.2 + 0.05 * turn)))
    drawn = left.groupBy("token", band.alias("band")).agg(
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "n", "pos", "root")).alias("hub")
    )
    drawn = drawn.select(
        F.col("token").alias("hub_token"), "band", F.col("hub.node").alias("b"), F.col("hub.n").alias("n2"),
        F.col("hub.pos").alias("pos2"), F.col("hub.root").alias("root2"),
    )
    mine = left.select(
        "token", band.alias("own_band"), F.col("node").alias("a"), F.col("n").alias("n1"), F.col("pos").alias("pos1"), "root"
    )
    near = mine.withColumn("to_band", F.explode(F.array(F.expr("own_band - 1"), F.expr("own_band"), F.expr("own_band + 1"))))
    pairs = near.join(drawn, (F.col("token") == F.col("hub_token")) & (F.col("to_band") == F.col("band")))
    return pairs.where((F.col("root") != F.col("root2")) & _sql_filters(percent)).select("a", "b").distinct()


def _rest(left: DataFrame, percent: int) -> DataFrame:
    """Sets of different components that share a shingle and pass the filters, the smaller one being strong.

    One of the two is outside the shingle's largest component, so a group of copies is not paired with itself.
    """
    one = left.where("minor").select(
        "token", F.col("node").alias("a"), F.col("n").alias("n1"), F.col("pos").alias("pos1"), F.col("root").alias("root1")
    )
    other = left.select("token", F.col("node").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("root").alias("root2"))
    return one.join(other, "token").where((F.col("root1") != F.col("root2")) & _sql_filters(percent)).select("a", "b").distinct()


def _verified(
    pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, gram: int, folder: str, name: str
) -> DataFrame:
    """``a``, ``b``, ``similar`` for each pair: the suffix filter, then the intersection of what it leaves."""
    parts = [nodes.select(F.col("node").alias(x), F.col("parts").alias(f"parts_{x}")) for x in "ab"]
    counted = pairs.join(parts[0], "a").join(parts[1], "b").select("a", "b", "parts_a", "parts_b")
    filtered = staged(
        counted.mapInArrow(lambda batches: _possible(batches, percent), "a long, b long, possible boolean"),
        folder, f"{name}_filtered",
    )
    left = filtered.where("possible").select("a", "b")
    ends = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct()
    ends = staged(nodes.join(ends, "node", "left_semi").select("node", "example.key", "example.text_key"), folder, f"{name}_ends")
    # the same plan at every size, not a broadcast while there are few
    found = staged(
        texts.select("key", "text_key", "text").join(ends.hint("merge"), ["key", "text_key"])
        .dropDuplicates(["key", "text_key"]).select("node", "text"),
        folder, f"{name}_texts",
    )
    one = found.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = found.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = left.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    checked = both.mapInArrow(lambda batches: _intersected(batches, percent, gram), "a long, b long, similar boolean")
    rest = filtered.where("not possible").select("a", "b", F.lit(False).alias("similar"))
    found = staged(checked.unionByName(rest), folder, name)
    remove(folder, f"{name}_filtered", f"{name}_ends", f"{name}_texts", spark=texts.sparkSession)
    return found


def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Suffix filter: the members of two sets by hash range bound their intersection from above."""
    for batch in batches:
        possible = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = _counts(x.as_buffer()), _counts(y.as_buffer())
            possible[i] = np.minimum(x, y).sum() >= _needed(int(x.sum()), int(y.sum()), percent)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(possible)], ["a", "b", "possible"])


def _intersected(batches: Iterator[pa.RecordBatch], percent: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        similar = np.zeros(batch.num_rows, bool)
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            sets = [_list_of_sets(rows.column(k), gram) for k in (2, 3)]
            for i, (x, y) in enumerate(zip(*sets)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                similar[lo + i] = common >= _needed(len(x), len(y), percent)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similar)], ["a", "b", "similar"])


def _list_of_sets(column: pa.Array, gram: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for w in split_words(column, lower=True):
        hashes, first = shingle_sets(w, gram)
        out += np.split(hashes, first[1:-1])
    return out


def _parts(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """How many members of each set fall into each of SUFFIX_PARTS ranges of hashes."""
    texts = len(first) - 1
    at = np.repeat(np.arange(texts), np.diff(first)) * SUFFIX_PARTS
    at += (hashes >> np.uint64(64 - SUFFIX_PARTS.bit_length() + 1)).astype(np.int64)
    counts = np.bincount(at, minlength=texts * SUFFIX_PARTS).reshape(texts, SUFFIX_PARTS)
    return [row.astype(np.uint16 if row.max() < 65536 else np.uint32).tobytes() for row in counts]


def _counts(blob: pa.Buffer) -> np.ndarray:
    return np.frombuffer(blob, np.uint16 if blob.size == 2 * SUFFIX_PARTS else np.uint32).astype(np.int64)
