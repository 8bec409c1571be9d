"""The operators as queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.bpe_transducer import build_lexicon, round_trip
from daymark.llm.chat_format import format_chats, read_back
from daymark.llm.conversation_repair import damaged, repair_conversations, summaries
from daymark.llm.decontaminate import find_leaks
from daymark.llm.hard_negatives import mine_hard_negatives
from daymark.llm.jaccard_join import similar_groups
from daymark.llm.line_dedup import drop_near_lines
from daymark.llm.lm_trie import score, train
from daymark.llm.minhash_forest import near_copies
from daymark.llm.quality_rules import rate_quality
from daymark.llm.secret_scan import guess_dictionary, scan_secrets
from daymark.llm.shared import shared_folder
from daymark.llm.substring_dedup import remove_repeats
from daymark.llm.token_files import read_token_files, write_token_files

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
BENCHMARK = "item_id BIGINT, text STRING"
EMBEDDINGS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
CONVERSATIONS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, schema: str = DOCUMENTS) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark", BENCHMARK))
    return found.select("doc_id", "item_id", "score", "n_words", "n_substituted", "begin", "item_begin")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate_quality(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rated.select("doc_id", *base, "base_failed", "kept", F.round("quality", 4).alias("quality"))


def op5_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    model = train(documents.where(~held_out), order=3, least_count=1)
    return score(documents, model, held_out).withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


def tokenizer(name: str) -> str:
    """A public tokenizer's file; the same place on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 2, folder)
    found = read_token_files(spark, manifest)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return found.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_near_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", CONVERSATIONS)
    awkward = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)], CONVERSATIONS)
    found = read_back(format_chats(conversations.unionByName(more)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("losses", "")
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op9_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, path = table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")
    return round_trip(documents, path, build_lexicon(documents, path)).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = scan_secrets(documents, guess_dictionary(documents))

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(repair_conversations(damaged(table(spark, sf_dir, "conversations", CONVERSATIONS))))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", EMBEDDINGS)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(
        rows.select("vec_id", moved.alias("label"), F.col("embedding").alias("vector"), (F.col("vec_id") % 100 == 0).alias("is_anchor"))
    )


def op13_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


QUERIES = {
    query.__name__: query
    for query in (
        op1_decontaminate, op2_substring_dedup, op3_token_files, op4_quality_rules, op5_lm_trie, op6_jaccard_join,
        op7_line_dedup, op8_chat_format, op9_bpe_transducer, op10_secret_scan, op11_conversation_repair,
        op12_hard_negatives, op13_minhash_forest,
    )
}
ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        k AS (
            SELECT r, a, array_to_string(w[a : a + 34], ' ') AS k
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS a FROM d WHERE len(w) >= 35)),
        found AS (SELECT r, a FROM k QUALIFY count(*) OVER (PARTITION BY k) > 1),
        gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(a, a + 35)) AS p FROM found)),
        word AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
        kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
        n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)""",
    "op12_hard_negatives": """
        WITH e AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
                CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM e AS a JOIN e AS b ON a.r <> b.r AND a.vec_id % 100 = 0),
        p AS (
            SELECT * FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, b) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST, s.b) AS INTEGER) AS rank,
            s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
        QUALIFY rank <= 5""",
    "op8_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (
            SELECT *, 17 + length(regexp_replace(role || text, '[\\<>]', 'xx', 'g')) AS n,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS ends
            FROM c),
        f AS (
            SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM e)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
            CAST(sum(CASE WHEN role = 'assistant' OR ends THEN upto END) AS BIGINT) AS formatted_chars
        FROM f GROUP BY conv_id""",
}
