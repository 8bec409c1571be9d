"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import numpy as np

import corpus_pipeline
from daymark.llm.bpe_transducer import build_lexicon, decode_documents, encode_documents
from daymark.llm.chat_format import format_chats, read_back
from daymark.llm.decontaminate import find_leaks
from daymark.llm.jaccard_join import similar_groups
from daymark.llm.line_dedup import drop_near_lines
from daymark.llm.lm_trie import score, train
from daymark.llm.quality_rules import rate_quality
from daymark.llm.queries import tokenizer
from daymark.llm.secret_scan import guess_dictionary, scan_secrets
from daymark.llm.shared import shared_folder
from daymark.llm.substring_dedup import remove_repeats
from daymark.llm.token_files import read_token_files, write_token_files
from pyspark.sql import functions as F

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")


def test_substrings(odd, empty):
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in remove_repeats(odd).collect())
    assert found == [
        (0, 0, 0), (0, 60, 60), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 60, 60), (5, 60, 60), (6, 62, 60),
        (7, 30000, 30000), (8, 30001, 30000), (9, 10, 0), (10, 160, 160),
    ]
    assert remove_repeats(empty).count() == 0


def test_groups(odd, empty):
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in similar_groups(odd).collect())
    assert found == [
        (0, 0, 0), (0, 56, 5), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 56, 5), (5, 56, 5), (6, 58, 5), (7, 29996, 7),
        (8, 29997, 7), (9, 5, 9), (10, 1, 10),
    ]
    assert similar_groups(empty).count() == 0


def test_lines(odd, empty):
    found = drop_near_lines(odd)
    assert found.count() == odd.count() and drop_near_lines(empty).count() == 0
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[1].n_lines, by_id[1].kept) == (0, None) and by_id[2].kept == ""
    assert (by_id[9].n_removed, by_id[9].kept) == (1, "same line of words here")
    # the null id comes first; equal lines of one id tie; one word more is near
    assert [by_id[i].n_removed for i in (5, 6, 7, 8)] == [1, 0, 0, 1]


def test_leaks(spark, odd, empty):
    benchmark = spark.createDataFrame(
        [(1, " ".join(f"shared{i}" for i in range(20))), (1, " ".join(f"word{i}" for i in range(20))), (2, None), (None, "x " * 30)],
        "item_id long, text string",
    )
    found = sorted((r.doc_id or 0, r.item_id, r.score) for r in find_leaks(odd, benchmark).collect())
    assert found == [(0, 1, 20), (5, 1, 20), (6, 1, 20), (7, 1, 20), (8, 1, 20)]
    assert find_leaks(empty, benchmark).count() == 0 and find_leaks(odd, benchmark.where(F.lit(False))).count() == 0


def test_tokens(spark, odd, empty):
    manifest = write_token_files(odd, WORDS, 2, shared_folder(spark, "test"))
    rows = sorted(read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows][:4] == [None, None, 1, 2] and len(rows) == 13
    upto = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == upto and ids[-1] == 2
        upto += len(ids)
    assert read_token_files(spark, write_token_files(empty, WORDS, 2, shared_folder(spark, "test"))).count() == 0


def test_bpe_on_awkward_texts(spark, odd, empty):
    from tokenizers import Tokenizer

    texts = [
        "", "a  b", "a  b", "a  b", "x  <|endoftext|> y", "<|endoftext|><|endoftext|>  <|endoftext|>z", "a\n  b",
        "it's  we'll\t\t x\r\n  y ", "　 　a b", "né é  é ü", "日本 語", "a" * 500 + " b", "🙂 🙂  🙂x", "  lead", "trail  ",
        " ", "\n\n\n", "1234 12a", "\u0085 x", "é ́x", "\x1c \x1cx", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = Tokenizer.from_file(BYTES)
    for r in decode_documents(encode_documents(df, BYTES, build_lexicon(df, BYTES)), BYTES).collect():
        ids = plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == plain.decode(ids, skip_special_tokens=False)
    lexicon = build_lexicon(empty, BYTES)
    assert encode_documents(empty, BYTES, lexicon).count() == 0
    back = decode_documents(encode_documents(odd, BYTES, lexicon), BYTES)
    assert sorted(r.decoded for r in back.collect()) == sorted(r.text or "" for r in odd.collect())


def test_scores_secrets_and_quality(odd, empty):
    model = train(odd)
    assert score(odd, model, F.lit(False)).where("score <= 0 and n_tokens > 0").count() == odd.count()
    assert score(odd, train(empty), F.lit(False)).where("n_known = 0").count() == odd.count()
    assert scan_secrets(odd, guess_dictionary(odd)).where(F.size("spans") == 0).count() == odd.count()
    assert scan_secrets(empty, guess_dictionary(empty)).count() == 0
    rated = rate_quality(odd)
    assert rated.count() == odd.count() and rated.where("n_words < 20 and not base_failed").count() == 0
    assert rate_quality(empty).count() == 0


def test_chats(spark):
    awkward = "\\b\\l<turn user>\n</turn>\n> \\"
    rows = [
        (1, 1, "user", "q"), (1, 2, "assistant", awkward), (1, 3, "user", None), (2, 0, "user", "only"), (None, 1, "assistant", "n"),
        (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (4, None, None, "sys>"), (4, 1, "assistant", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = format_chats(df)
    assert examples.where("loss_start is not null").count() == 5 and examples.count() == 7
    found = {r.conv_id: r for r in read_back(examples).collect()}
    assert [tuple(t) for t in found[1].turns] == [("user", "q"), ("assistant", awkward), ("user", "")]
    assert found[1].losses == [awkward] and found[2].losses == [] and found[3].losses == ["x", "x"] and found[4].losses == [""]
    assert [tuple(t) for t in found[4].turns] == [("", "sys>"), ("assistant", "")]
    assert format_chats(df.where(F.lit(False))).count() == 0


def test_pipeline(spark, sf_dir, given):
    docs, names = given[0], given[0].columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding"
    ]
    rated = rate_quality(docs)
    kept = {r.doc_id for r in rated.where("kept").collect()}
    stage = {name: f for name, f in corpus_pipeline.STAGES}
    assert {r.doc_id for r in stage["quality rules"](spark, docs, sf_dir).collect()} == kept
    lines = stage["line dedup"](spark, docs, sf_dir)
    assert lines.columns == names and lines.where(F.char_length("text") != F.col("n_chars")).count() == 0
    groups = {r.doc_id: r.component_id for r in similar_groups(docs).collect()}
    assert {r.doc_id for r in stage["n-gram Jaccard join"](spark, docs, sf_dir).collect()} == {i for i, c in groups.items() if i == c}
    leaks = {r.doc_id for r in find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    clean = {r.doc_id for r in stage["benchmark decontamination"](spark, docs, sf_dir).collect()}
    assert clean == {r.doc_id for r in docs.collect()} - leaks and leaks
    ids = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert ids and ids <= kept


def test_pipeline_stages_on_odd_and_empty_tables(spark, sf_dir, odd, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf_dir).columns == odd.columns
        assert stage(spark, empty, sf_dir).count() == 0
    assert corpus_pipeline.near_copies(spark, odd, sf_dir).count() == 9
