"""Every operator's query against a brute-force version on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm.decontaminate import find_leaks
from daymark.llm.lm_trie import score, train
from daymark.llm.queries import ORACLES, QUERIES, tokenizer

from .conftest import WORD

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def by_doc(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, sf_dir).select(*columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


def test_leaks_are_those_that_share_eight_words(spark, sf_dir, given):
    words = lambda s: [x for x in re.split(r"[\W_]+", s.lower()) if x]
    grams = defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(r.text)
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add(r.item_id)
    want = set()
    for i, text in given[1]:
        w = words(text)
        want |= {(i, item) for k in range(len(w) - 7) for item in grams.get(tuple(w[k : k + 8]), ())}
    found = QUERIES["op1_decontaminate"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want


def test_leaks_survive_substitutions(spark):
    item = [f"w{i}" for i in range(40)]
    spoilt = [("zz" if i % 6 == 5 else w) for i, w in enumerate(item)]
    texts = {1: "before, " + " ".join(item).upper() + ". after", 2: "before " + " ".join(spoilt), 3: " ".join(item[:6]), 4: "clean text " * 20}
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, " ".join(item)), (8, "too short"), (7, None)], "item_id long, text string")
    found = by_doc(find_leaks(documents, benchmark))
    assert set(found) == {1, 2}
    assert (found[1].n_words, found[1].n_substituted, found[1].begin, found[1].item_begin) == (40, 0, 1, 0)
    assert found[2].n_words >= 35 and found[2].n_substituted >= 5


def test_token_files(spark, sf_dir, given):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    found, start = by_doc(QUERIES["op3_token_files"](spark, sf_dir)), 0
    for i, text in given[1]:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        want = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == want
        start += len(ids)


def test_bpe(spark, sf_dir, given):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    found = by_doc(QUERIES["op9_bpe_transducer"](spark, sf_dir))
    for i, text in given[1]:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert found[i].decoded_sha256 == sha(plain.decode(ids, skip_special_tokens=False))


def test_quality(spark, sf_dir, given):
    found = by_doc(QUERIES["op4_quality_rules"](spark, sf_dir))
    for i, text in given[1]:
        w, seen, dup = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        r = found[i]
        want = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)


def test_quality_agrees_with_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = [r for r in QUERIES["op4_quality_rules"](spark, sf_dir).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in found if labels[r.doc_id] == 1]
    poor = [r.kept for r in found if labels[r.doc_id] == 0]
    assert sum(good) > 0.97 * len(good) and sum(poor) < 0.15 * len(poor)


def _trigrams(given):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = {i: [*WORD.findall(text.translate(LOWER)), ""] for i, text in given}
    one, two = Counter(), Counter()
    starts = 0
    for i, w in tokens.items():
        if not held(i):
            one.update(w)
            two.update(zip([None, *w], w))
            starts += 1
    return held, tokens, one, two, starts


def test_lm_base_scores(spark, sf_dir, given):
    held, tokens, one, _, _ = _trigrams(given[1])
    n, v = sum(one.values()), len(one)
    single = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    found = by_doc(QUERIES["op5_lm_trie"](spark, sf_dir))
    for i, w in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(one[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10(single(x)) for x in w), abs=1e-6)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_is_a_distribution_and_takes_higher_orders(spark):
    texts = spark.createDataFrame([(i, "a b c a b d") for i in range(3)] + [(9, None)], "doc_id long, text string")
    for order in (2, 3):
        model = train(texts, order=order)
        probes = spark.createDataFrame([(1, "a b c a b d"), (2, ""), (3, "zz zz")], "doc_id long, text string")
        got = by_doc(score(probes, model, F.lit(False)))
        assert got[1].score > got[1].base_score and got[3].n_known == 1 and got[2].n_tokens == 1
    # the chances of all next words, the unknown one included, add up
    words = ["a", "b", "c", "d", "zz"]
    probes = spark.createDataFrame([(i, f"a {w}") for i, w in enumerate(words)] + [(9, "a")], "doc_id long, text string")
    got = by_doc(score(probes, train(texts, order=2), F.lit(False)))
    tail = {w: got[i].score for i, w in enumerate(words)}
    ends = by_doc(score(spark.createDataFrame([(0, "")], "doc_id long, text string"), train(texts, order=1), F.lit(False)))
    assert all(x < 0 for x in tail.values()) and ends[0].score == pytest.approx(ends[0].base_score)


def test_jaccard_components(spark, sf_dir, given):
    sets, where = {}, defaultdict(list)
    for i, text in given[1]:
        w = WORD.findall(text.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        for s in sets[i]:
            where[s].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j, n in Counter(j for s in sets[i] for j in where[s] if j < i).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    found = by_doc(QUERIES["op6_jaccard_join"](spark, sf_dir))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == {i: (len(s), root(i)) for i, s in sets.items()}


def test_secrets(spark, sf_dir, given):
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )
    found = by_doc(QUERIES["op10_secret_scan"](spark, sf_dir))
    for i, text in given[1]:
        spans = sorted(
            (m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(kinds) for m in p.finditer(text) if len(m[g]) >= least
        )
        assert found[i].base_sha256 == sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans))
        assert found[i].n_hex == sum(s[2] == "hex" for s in spans)
