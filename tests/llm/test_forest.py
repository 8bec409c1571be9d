"""MinHash near-dedup against the similarities of all pairs."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from daymark.llm.minhash_forest import near_copies, signatures
from daymark.llm.queries import QUERIES

from .conftest import DOCUMENTS, WORD

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, gram=4):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset([tuple(words)] if 0 < len(words) < gram else [tuple(words[i : i + gram]) for i in range(len(words) - gram + 1)])


def exact(docs, percent=80, gram=4):
    """Size and component of each row, and the links between different sets, by comparing all sets that share a shingle."""
    sets = [shingles(text, gram) for _, text in docs]
    distinct = {s: k for k, s in enumerate(dict.fromkeys(s for s in sets if s))}
    having = {}
    for s, k in distinct.items():
        for x in s:
            having.setdefault(x, []).append(k)
    common = {}
    for ks in having.values():
        for pair in combinations(ks, 2):
            common[pair] = common.get(pair, 0) + 1
    size = {k: len(s) for s, k in distinct.items()}
    links = [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (size[a] + size[b] - c)]
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for (i, _), s in zip(docs, sets):
        if s and i is not None:
            least[root(distinct[s])] = min(i, least.get(root(distinct[s]), i))
    return [(i, len(s), least.get(root(distinct[s])) if s else i) for (i, _), s in zip(docs, sets)], links


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_query(spark, sf_dir, given):
    want, links = exact(given[1])
    got = QUERIES["op13_minhash_forest"](spark, sf_dir)
    assert links and found(got) == sorted(want, key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_odd_rows(spark, odd):
    want, _ = exact([(r.doc_id, r.text) for r in odd.collect()])
    assert found(near_copies(odd)) == sorted(want, key=str)


def test_empty(empty):
    assert near_copies(empty).collect() == []


def test_crowds(spark):
    """One text copied with changes in other places, a passage that many share, pairs among them, and clean texts."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    original, passage = [word() for _ in range(160)], [word() for _ in range(40)]
    docs = [(0, " ".join(original))]
    for i in range(1, 500):  # like the original, mostly not like each other
        changed = list(original)
        for at in draw.sample(range(160), 4):
            changed[at] = word()
        docs.append((i, " ".join(changed)))
    for i in range(500, 1100):
        docs.append((i, " ".join(passage + [word() for _ in range(60)])))
    for i in range(1100, 1200):
        near = WORD.findall(docs[i - 600][1])
        near[70] = word()
        docs.append((i, " ".join(near)))
    want, links = exact(docs)
    assert len(links) > 500
    draw.shuffle(docs)
    df = spark.createDataFrame([(i, t, "en", "k", 1, "w", 2) for i, t in docs], DOCUMENTS).withColumns({"name1": F.lit(1), "signature": F.lit(2)})
    got = {r.doc_id: r.component_id for r in near_copies(df).collect()}
    right = sum(got[i] == component for i, _, component in want)
    assert right >= 0.999 * len(want)


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**64, 4000, dtype=np.uint64)
    rates = []
    for k in range(40):
        both = [np.sort(pool[100 * k : 100 * k + 90]), np.sort(pool[100 * k + 10 : 100 * k + 100])]  # 80 of 100
        one, other = signatures(np.concatenate(both), np.array([0, 90, 180]))
        rates.append((one == other).mean())
    assert abs(np.mean(rates) - 0.8) < 0.03
    assert not signatures(pool[:0], np.array([0, 0])).any()
