"""Quality verdicts, guess costs and the whole pipeline against plain Python over single documents."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from daymark.llm.queries import QUERIES, tokenizer
from daymark.llm.secret_scan import GuessCost

from .conftest import WORD
from .test_forest import exact
from .test_whole import near_lines


def votes_of(text):
    """The base verdict and the nine votes of a text."""
    w = WORD.findall(text)
    n, chars = len(w), sum(map(len, w))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = {}
    for k in range(n - 7):
        windows.setdefault(tuple(w[k : k + 8]), []).append(k)
    repeat = len({p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)})
    symbols, marked = sum(c in "#*$%&|<>" for c in text), sum(any(c in "#*$%&|<>" for c in x) for x in w)
    upper, letters = sum("A" <= c <= "Z" for c in text), sum(c.isascii() and c.isalpha() for c in text)
    alphabetic = letters + sum(ord(c) > 127 for c in text)
    vote = lambda poor, good: -1 if poor else 1 if good else 0
    return n < 20 or 100 * repeat > 30 * n, (
        vote(n < 20, n >= 40), vote(100 * repeat > 30 * n, 100 * repeat <= 5 * n),
        vote(100 * (len(lines) - len(set(lines))) > 30 * len(lines), len(lines) == len(set(lines)) > 1),
        vote(100 * symbols > 15 * n, 100 * symbols <= 3 * n), vote(100 * marked > 10 * n, 100 * marked <= 2 * n),
        vote(100 * alphabetic < 85 * chars, 100 * alphabetic >= 92 * chars), vote(chars < 3 * n or chars > 15 * n, chars <= 10 * n),
        vote(100 * upper > 40 * letters, 100 * upper <= 20 * letters), vote(n >= 50 and 100 * len(set(w)) < 25 * n, 100 * len(set(w)) >= 40 * n),
    )


def rated(texts):
    """Whether each text is kept: EM over the texts one by one, by the model that ``quality_rules`` states."""
    found = [votes_of(text) for text in texts]
    good, if_good, if_poor = 0.9, [0.02] * 9, [0.4] * 9

    def chance(votes):
        odds = math.log(good / (1 - good))
        for v, g, p in zip(votes, if_good, if_poor):
            odds += math.log(g / p) if v < 0 else math.log((1 - g) / (1 - p)) if v > 0 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(200):
        weights = [chance(v) for _, v in found]

        def share(weights, rule, start):
            poor = sum(x for x, (_, v) in zip(weights, found) if v[rule] < 0)
            return (poor + 10 * start) / (sum(x for x, (_, v) in zip(weights, found) if v[rule]) + 10)

        other = [1 - x for x in weights]
        if_good = [share(weights, k, 0.02) for k in range(9)]
        if_poor = [share(other, k, 0.4) for k in range(9)]
        good = (sum(weights) + 9) / (len(found) + 10)
    return [not failed and chance(v) >= 0.5 for failed, v in found]


def test_quality_verdicts(spark, sf_dir, given):
    kept = {r.doc_id: r.kept for r in QUERIES["op4_quality_rules"](spark, sf_dir).collect()}
    want = dict(zip((i for i, _ in given[1]), rated([text for _, text in given[1]])))
    assert kept == want and 0 < sum(want.values()) < len(want)


def test_pipeline(spark, sf_dir, given):
    """Every stage in plain Python, one after the other, gives the documents, ids and texts of ``run``."""
    docs = [d for d, keep in zip(given[1], rated([text for _, text in given[1]])) if keep]
    cleaned = near_lines(docs)
    docs = [(i, cleaned[i][1]) for i, _ in docs if cleaned[i][0] == 0 or WORD.search(cleaned[i][1])]
    components, _ = exact(docs, 75, 5)
    docs = [d for d, (i, _, least) in zip(docs, components) if i == least]
    words = lambda s: [x for x in re.split(r"[\W_]+", s.lower()) if x]
    grams = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(r.text)
        grams |= {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    docs = [(i, t) for i, t in docs if not any(tuple(words(t)[k : k + 8]) in grams for k in range(len(words(t)) - 7))]
    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    want = {}
    for i, text in docs:
        ids = plain.encode(text, add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(decoded.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and 50 < len(want) < len(given[1])


# fixed values: keys of a US keyboard by row
KEYS = {c: (y, x) for y, pair in enumerate((
    ("1234567890-=", "!@#$%^&*()_+"), ("qwertyuiop[]", "QWERTYUIOP{}"), ("asdfghjkl;'", 'ASDFGHJKL:"'), ("zxcvbnm,./", "ZXCVBNM<>?"),
)) for row in pair for x, c in enumerate(row)}


def least_cost(value, ranks):
    """The least sum over all segmentations, each segment priced by itself."""
    single = lambda c: math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)

    def prices(s):
        yield sum(map(single, s))
        for leet in (False, True):
            swapped = "".join({"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}.get(c, c) for c in s.lower())
            word = swapped if leet else s.lower()
            if 2 <= len(s) <= 32 and word in ranks and not (leet and s.lower() in ranks):
                upper = sum(c.isupper() for c in s)
                case = 0.0
                if upper and (s.isupper() or upper == 1 and (s[0].isupper() or s[-1].isupper())):
                    case = math.log10(2)
                elif upper:
                    case = math.log10(sum(math.comb(len(s), k) for k in range(1, min(upper, len(s) - upper) + 1)) or 1)
                yield math.log10(ranks[word]) + case + (math.log10(2) * sum(a != b for a, b in zip(word, s.lower())) if leet else 0)
        for period in range(1, 9):
            times = len(s) // period
            if times >= 2 and len(s) == times * period >= 3 and s == s[:period] * times:
                yield sum(map(single, s[:period])) + math.log10(times)
        steps = [(KEYS[b][0] - KEYS[a][0], KEYS[b][1] - KEYS[a][1]) if a in KEYS and b in KEYS else None for a, b in zip(s, s[1:])]
        if 3 <= len(s) <= 33 and all(d and d != (0, 0) and max(map(abs, d)) <= 1 for d in steps):
            turns = 1 + sum(a != b for a, b in zip(steps, steps[1:]))
            yield math.log10(47 * len(s)) + turns * math.log10(4.6)
        if re.fullmatch(r"(19|20)\d\d", s):
            yield math.log10(max(20, abs(int(s) - 2000))) + 2 * math.log10(2)

    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(
            [best[i] + (math.log10(2) if i else 0.0) + p for i in range(j) for p in prices(value[i:j])]
            + [best[i] + sum(map(single, value[i:j])) for i in range(j)]
        ))
    return best[-1]


@pytest.mark.parametrize("seed", range(3))
def test_guess_costs(seed):
    draw = random.Random(seed)
    ranks = {w: k for k, w in enumerate(("love", "pass", "word", "password", "dragon", "at", "sea"), 1)}
    cost = GuessCost(ranks)
    for _ in range(150):
        value = "".join(draw.choice(["love", "Pass", "w0rd", "qwer", "aaa", "xyxy", "1999", "$", "Z", "k", "7", "sea", "P4SSWORD", "é"]) for _ in range(draw.randint(1, 4)))
        if not re.search(r"\d[-/._]?\d{1,2}[-/._]?\d", value):  # full dates have a test of their own
            assert cost(value) == pytest.approx(least_cost(value, ranks), abs=1e-9), value
