"""A training corpus from raw documents: rate, clean, deduplicate, decontaminate, encode.

Every stage takes all documents that the one before kept.  What a stage decides takes effect in
its output: all but the last return rows with the columns of the documents they were given.
Repeated rows (equal id and text) share a fate, and the near-duplicate stage leaves one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.bpe_transducer import build_lexicon, round_trip
from daymark.llm.decontaminate import find_leaks
from daymark.llm.jaccard_join import similar_groups
from daymark.llm.line_dedup import drop_near_lines
from daymark.llm.quality_rules import rate_quality
from daymark.llm.queries import BENCHMARK, table, tokenizer
from daymark.llm.shared import row_key, shared_folder, staged

_ROW = ["row_key", "row_text_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("*", *(column.alias(name) for column, name in zip(row_key(docs), _ROW)))


def _rows(found: DataFrame) -> DataFrame:
    return found.select(F.col("key").alias(_ROW[0]), F.col("text_key").alias(_ROW[1]))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out what the rules' posterior, or the base limits, reject.  Verdicts depend on the text alone."""
    kept = rate_quality(docs, carry=tuple(docs.columns)).where("kept")
    return kept.select(*(F.col("carried").getField(name).alias(name) for name in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out lines that an earlier line repeats, and documents that have no word left."""
    others = tuple(name for name in docs.columns if name not in ("doc_id", "text"))
    found = drop_near_lines(docs, carry=others)
    found = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    columns = {name: F.col("carried").getField(name) for name in others}
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*(columns[name].alias(name) for name in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one document of each group of near copies, the one with the least id."""
    groups = similar_groups(docs)
    first = groups.where("component is not null").groupBy("component").agg(F.min(F.struct("key", "text_key")).alias("row"))
    kept = _rows(first.select("row.*")).unionByName(_rows(groups.where("component is null"))).distinct()
    return _keyed(docs).join(kept, _ROW, "left_semi").dropDuplicates(_ROW).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that overlap with a benchmark item."""
    leaks = _rows(find_leaks(docs, table(spark, sf_dir, "benchmark", BENCHMARK))).distinct()
    return _keyed(docs).join(leaks, _ROW, "left_anti").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), ``decoded_sha256``."""
    path = tokenizer("byte_bpe_50k.json")
    found = round_trip(docs, path, build_lexicon(docs, path))
    return found.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding", encoded),
]

#: Expectation-maximisation and BPE cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, with a Parquet table between each two."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = staged(stage(spark, docs, sf_dir), folder, f"stage_{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
