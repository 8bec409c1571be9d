"""Hard negatives against SQL and against plain inner products."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from daymark.llm import hard_negatives
from daymark.llm.hard_negatives import Packed, mine_hard_negatives
from daymark.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, label int, vector array<double>, is_anchor boolean, copies string, row_id int, g int"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf_dir, sf):
    folder = sf_dir.replace("sf0.001", sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(ORACLES["op12_hard_negatives"])
    columns = [d[0] for d in want.description]
    got = QUERIES["op12_hard_negatives"](spark, folder).select(*columns)
    want = Counter(want.fetchall())
    assert want and Counter(map(tuple, got.collect())) == want


def plain(rows):
    use = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [[int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256) for x in r[2]] for r in use]
    out = []
    for i, anchor in enumerate(use):
        if not anchor[3]:
            continue
        score = [max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(whole[i], v)))) for v in whole]
        order = sorted(range(len(use)), key=lambda j: (-score[j], use[j][0] is None, use[j][0] or 0))
        for p in [j for j in order if j != i and use[j][1] == anchor[1]][:5]:
            near = [j for j in order if use[j][1] != anchor[1] and 80 * score[p] <= 100 * score[j] <= 100 * score[p]][:5]
            out += [(anchor[0], use[p][0], k + 1, use[j][0], score[p], score[j]) for k, j in enumerate(near)]
    return Counter(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS)
    found = mine_hard_negatives(df)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, found.collect()))


def made(seed, n, spread=1.0, dims=4):
    draw = random.Random(seed)
    return [(i, draw.choice([0, 0, 0, 1, 2]), [draw.uniform(-spread, spread) for _ in range(dims)], i % 9 == 0) for i in range(n)]


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    odd = [
        (900, None, [1.0] * 4, True), (901, 1, None, True), (902, 1, [1.0, None], True), (903, 1, [nan], True), (904, 1, [inf], True),
        (None, 0, [0.5, 0.5, 0.5, 0.5], None), (None, 1, [0.5] * 4, True), (905, 1, [], True), (906, 2, [1.0], True),
        (907, 0, [0.0] * 4, True), (908, 1, [-0.0] * 6, True), (-7, 1, [2.0] * 4, True),
    ]
    rows = made(1, 120) + odd + [(40, 0, [0.5] * 4, True)] * 3 + [(41, 1, [0.5] * 4, False)] * 9
    for packed in (1, 7, 1024):
        monkeypatch.setattr(hard_negatives, "PACKED", packed)
        want = plain(rows)
        assert len(want) > 100 and mined(spark, rows) == want


def test_large_components(spark):
    rows = made(2, 40, 1e6) + made(3, 30, 1e30) + [(500, 0, [1e300] * 4, True), (501, 1, [1.7e308, -1.7e308], False)]
    assert mined(spark, rows) == plain(rows)


def test_empty(spark):
    assert not mined(spark, []) and not mined(spark, [(1, 0, [1.0], True)])


def test_cells_of_any_size_give_the_same(spark, monkeypatch):
    rows = made(4, 300)
    want = plain(rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 10)
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    assert mined(spark, rows) == want


@pytest.mark.parametrize("spread", [1, 200, 10**5, 10**9, 10**18, 10**30])
def test_packed_products_are_exact(spread):
    draw = random.Random(spread)
    rows, anchors = ([[draw.randint(-spread, spread) for _ in range(13)] for _ in range(n)] for n in (50, 4))
    kind = np.int64 if spread < 2**61 else object
    block = Packed(np.array(rows, kind), np.array(anchors, kind))
    for a, anchor in enumerate(anchors):
        want = [sum(x * y for x, y in zip(row, anchor)) for row in rows]
        assert block.scores(a).tolist() == [max(1 - 2**63, min(2**63 - 1, x)) for x in want]
