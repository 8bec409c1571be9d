"""Words and sequences that polynomial hashes modulo powers of two cannot tell apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymark.llm.bpe_transducer import build_lexicon, encode_documents
from daymark.llm.jaccard_join import similar_groups
from daymark.llm.lm_trie import score, train
from daymark.llm.memo import Memo
from daymark.llm.minhash_forest import near_copies
from daymark.llm.quality_rules import rate_quality
from daymark.llm.queries import tokenizer
from daymark.llm.shared import shared_folder
from daymark.llm.substring_dedup import remove_repeats
from daymark.llm.token_files import read_token_files, write_token_files
from daymark.llm.words import sequence_hashes, span_hashes

from .conftest import WORD


def thue_morse(n, one, other):
    return [(one, other)[bin(i).count("1") % 2] for i in range(n)]


FIRST, SECOND = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))


@pytest.fixture(scope="module")
def pair(spark):
    around = " ".join(f"w{i}" for i in range(34))
    rows = [(0, FIRST), (1, SECOND), (2, f"{around} {FIRST}"), (3, f"{around} {SECOND}"), (4, f"{FIRST}\n{SECOND}\n{FIRST}")]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


@pytest.mark.parametrize("size", [64, 512, 1024, 4096])
def test_patterns_have_different_hashes(size):
    data = np.frombuffer("".join(thue_morse(size, "a", "b") + thue_morse(size, "b", "a")).encode(), np.uint8)
    assert len(set(span_hashes(data, np.array([0, size]), np.array([size, 2 * size])).tolist())) == 2
    words = span_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 1]), np.array([1, 2]))
    run = words[thue_morse(size, 0, 1) + thue_morse(size, 1, 0)]
    assert len(set(sequence_hashes(run, np.array([0, size]), size).tolist())) == 2


def test_sequences_hash_alike_wherever_they_stand():
    draw = np.random.default_rng(3)
    run = draw.integers(0, 2**64, 400, dtype=np.uint64)
    run[200:] = run[:200]
    begin, length = draw.integers(0, 100, 50), draw.integers(0, 100, 50)
    assert (sequence_hashes(run, begin, length) == sequence_hashes(run, begin + 200, length)).all()
    assert sequence_hashes(run, begin, 7).tolist() == sequence_hashes(run, begin, np.full(50, 7)).tolist()
    assert not len(sequence_hashes(run[:0], begin[:0], 5))


def test_memo_never_mixes_spans_of_one_hash(monkeypatch):
    import daymark.llm.memo as memo

    monkeypatch.setattr(memo, "span_hashes", lambda d, b, e, seed=0: span_hashes(d, b, e, seed) if seed else span_hashes(d, b, e) % np.uint64(40))

    def make(data, begin, end):
        spans = [data[b:e].tobytes() for b, e in zip(begin, end)]
        return np.array([x for span in spans for x in span], np.int32), np.array([len(span) for span in spans])

    draw, kept = np.random.default_rng(2), Memo(make, 4000)
    for _ in range(200):
        spans = [str(x).encode() for x in draw.integers(0, 200, draw.integers(1, 6))]
        end = np.cumsum([len(x) for x in spans])
        flat, lengths = kept(np.frombuffer(b"".join(spans), np.uint8), end - [len(x) for x in spans], end)
        assert bytes(flat.astype(np.uint8)) == b"".join(spans) and lengths.tolist() == [len(x) for x in spans]


def test_bpe(pair):
    df, texts = pair
    path = tokenizer("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    for r in encode_documents(df.coalesce(1), path, build_lexicon(df, path)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_token_files(spark, pair):
    df, texts = pair
    path = tokenizer("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    for r in read_token_files(spark, write_token_files(df, path, 2, shared_folder(spark, "test"))).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*plain.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]


def test_repeats_and_sets(pair):
    df, texts = pair
    assert all(r.n_removed == 0 for r in remove_repeats(df).collect())
    dup = {r.doc_id: r.n_dup_lines for r in rate_quality(df).collect()}
    assert dup == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1}
    for groups in (similar_groups(df), near_copies(df)):
        found = {r.doc_id: r.component_id for r in groups.collect()}
        assert found[0] == 0 and found[1] == 1


def test_known_words(pair):
    df, texts = pair
    found = {r.doc_id: r.n_known for r in score(df, train(df.where("doc_id in (0, 2)")), F.lit(False)).collect()}
    known = set(WORD.findall(texts[2]))
    assert found == {i: 1 + sum(w in known for w in WORD.findall(t)) for i, t in texts.items()}
