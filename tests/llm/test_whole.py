"""The registered queries do the whole job: no n-gram, line or value is left out."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymark.llm import lm_trie
from daymark.llm.decontaminate import find_leaks
from daymark.llm.line_dedup import drop_near_lines
from daymark.llm.queries import QUERIES
from daymark.llm.secret_scan import guess_dictionary, scan_secrets

from .conftest import WORD
from .test_operators import _trigrams, by_doc, sha


@pytest.mark.parametrize("shard_rows", [3_000_000, 7_000, 100])
def test_lm_scores_use_every_trigram(spark, sf_dir, given, monkeypatch, shard_rows):
    monkeypatch.setattr(lm_trie, "_SHARD_ROWS", shard_rows)
    held, tokens, one, two, starts = _trigrams(given[1])
    three = Counter()
    for i, w in tokens.items():
        if not held(i):
            three.update(zip([None, *w], w, w[1:]))
    n, v = sum(one.values()), len(one)
    after_one, after_two = Counter(a for a, _ in two), Counter((a, b) for a, b, _ in three)

    def chance(before, a, w):
        """P(w | before, a); ``a`` is None at the start of a text, ``before`` is then "none"."""
        p = (one[w] + 0.5) / (n + 0.5 * (v + 1))
        total = starts if a is None else one[a]
        if total:
            p = (max(two[a, w] - 0.75, 0) + 0.75 * after_one[a] * p) / total
        if before != "none" and two[before, a]:
            p = (max(three[before, a, w] - 0.75, 0) + 0.75 * after_two[before, a] * p) / two[before, a]
        return p

    found = by_doc(QUERIES["op5_lm_trie"](spark, sf_dir))
    for i, w in tokens.items():
        want = sum(math.log10(chance(*x)) for x in zip(["none", None, *w], [None, *w], w))
        assert abs(found[i].score - want) < 5e-4 * len(w)  # quantised


def near_lines(rows):
    """Lines removed from each (doc_id, text), in plain Python, and those left."""
    split = [(i, k, line, tuple(WORD.findall(line))) for i, text in rows for k, line in enumerate(text.split("\n"))]
    first = {}
    for i, k, _, w in split:
        if w:
            first.setdefault(w, (i, k))
    near = dict(first)
    for units in (lambda w: w, lambda w: tuple(" ".join(w)) if len(w) < 4 else ()):
        whole = {units(w): w for w in first}
        least = {}
        cut = {u: [(u[:q] + u[q + 1 :], q) for q in range(len(u))] if len(u) >= 4 else [] for u in whole}
        for u, w in whole.items():
            for key in cut[u]:
                least[key] = min(least.get(key, first[w]), first[w])
        for u, w in whole.items():
            for shorter, q in cut[u]:
                near[w] = min(near[w], least[shorter, q])
                if other := whole.get(shorter):
                    near[w], near[other] = min(near[w], first[other]), min(near[other], first[w])
    out, gone = {i: [] for i, _ in rows}, Counter()
    for i, k, line, w in split:
        if w and ((i, k) != first[w] or near[w] < first[w]):
            gone[i] += 1
        else:
            out[i].append(line)
    return {i: (gone[i], "\n".join(lines)) for i, lines in out.items()}


def test_lines_of_every_length(spark, sf_dir, given):
    found = by_doc(QUERIES["op7_line_dedup"](spark, sf_dir))
    assert {i: (r.n_removed, r.kept_sha256) for i, r in found.items()} == {i: (n, sha(kept)) for i, (n, kept) in near_lines(given[1]).items()}


def test_lines_of_one_id_are_ordered_too(spark):
    rows = [(5, "one line of words\nx"), (5, "one line of words\ny"), (5, "one line of words\nz"), (None, "q r s t u"), (None, "q r s t u\nv")]
    found = drop_near_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in found if r.doc_id == 5) == [0, 1, 1]
    assert sorted(r.n_removed for r in found if r.doc_id is None) == [0, 1]
    assert all(r.n_removed == 0 for r in drop_near_lines(spark.createDataFrame(rows[:1] * 3, "doc_id long, text string")).collect())


def test_short_lines_lose_repeats_and_near_ones(spark):
    texts = [
        "Les.\nab\n7\nKontakt 🙂\none two three four five six seven\na b c d", "Les.\nac\n7\nKontact 🙂\none two three 4 five six seven\na b c",
        "Les\n\n \nac\nKontakt  🙂\nb c d\na b e\nx y z\nx yz", "w x y\nd",
    ]
    rows = list(enumerate(texts))
    found = by_doc(drop_near_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_removed, r.kept) for i, r in found.items()} == near_lines(rows)
    assert found[1].kept == "ac" and found[2].kept == "\n \nx y z" and found[3].kept == "w x y\nd"


def test_repeated_secrets_stay_costly(spark):
    value = "kqzjvwxplm"
    texts = [f"the passphrase is {value} again" for _ in range(40)]  # copies
    texts += [f"note {i}: pwd: {value}!2024, token={value}" for i in range(40)]  # other texts around it
    texts += ["zu Hause, sagt sie", "Zu hause! sagt er", "(zu) HAUSE"] + ["kopie kopie kopie"] * 9 + [None, ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dictionary = guess_dictionary(documents)
    assert value not in dictionary and {"passphrase", "pwd", "token", "hause"} <= set(dictionary)
    # marks and case do not part a word, and a copied text counts once
    assert dictionary["hause"] < dictionary["sagt"] and dictionary["kopie"] > dictionary["token"]
    assert sorted(guess_dictionary(documents.where("doc_id >= 80"), 3)) == ["hause", "kopie", "zu"]
    found = by_doc(scan_secrets(documents, dictionary))
    assert all([s.kind for s in found[i].spans] == ["guess"] for i in range(40))
    assert all([s.kind for s in found[i].spans] == ["guess", "assign"] for i in range(40, 80))


def test_leaks_of_short_and_unnamed_items(spark):
    items = [(1, "What is the capital of France"), (2, "a b c d e f g"), (3, "forty-two"), (None, " ".join(f"n{i}" for i in range(12))), (4, "")]
    texts = {
        10: "Q: what is the capital of France? Paris", 11: "what is the capital of Spain", 12: "a b x d e f g", 13: "Forty two",
        14: "so " + " ".join(f"n{i}" for i in range(12)), 15: "", 16: "forty and two",
    }
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = find_leaks(documents, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.score, r.begin, r.item_begin) for r in found.collect()} == {
        (10, 1, 6, 1, 0), (13, 3, 2, 0, 0), (14, None, 12, 1, 0)
    }


@pytest.mark.parametrize("bits", [27, 4])
def test_texts_without_a_copy_are_not_shuffled(spark, monkeypatch, bits):
    from daymark.llm import secret_scan

    monkeypatch.setattr(secret_scan, "SLOT_BITS", bits)
    texts = [f"alone{chr(97 + i // 26)}{chr(97 + i % 26)} word" for i in range(200)] + ["copied text"] * 3 + [None, None, "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    keyed = docs.where("text is not null").select(F.xxhash64("text").alias("h1"), F.lit(0).cast("long").alias("h2"), "text")
    alone, others = ([r.text for r in df.collect()] for df in secret_scan.split_alone(keyed, iter, keyed.schema))
    assert sorted(alone + others) == sorted(t for t in texts if t is not None)
    assert {"copied text", ""}.isdisjoint(alone) and others.count("copied text") == 3
    assert len(others) == (5 if bits == 27 else 205)
    ranks = guess_dictionary(docs, 3)
    assert ranks == {"word": 1, "aloneaa": 2, "aloneab": 3} and len(guess_dictionary(docs)) == 203
