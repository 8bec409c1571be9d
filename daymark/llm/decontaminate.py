"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed is a hash of the words at the set places of a fixed mask; words at the other places may
differ.  Seeds of all benchmark items meet the seeds of all documents in one join.  Around each
hit the document is laid along the item, and the best-scoring run of words is taken: a word that agrees
scores 1, one that was substituted costs ``cost``.  A hit that scores enough is a leak.

Words are runs of letters and digits in lower case, so punctuation and case do not hide a leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import row_key

#: Places of each mask that count; a substitution at any other place goes unnoticed.
MASKS = ((0, 1, 3, 5, 6), (0, 1, 2, 5, 7), (0, 2, 3, 4, 6))
#: Benchmarks with at most this many seeds are sent to all tasks; larger ones are joined by shuffle.
BROADCAST_SEEDS = 1_000_000


def find_leaks(documents: DataFrame, benchmark: DataFrame, least: int = 10, cost: int = 2) -> DataFrame:
    """A row for each document row and benchmark item that overlap, at their best overlap.

    Returns ``doc_id``, ``key`` and ``text_key`` (the document row), ``item_id``, ``score``,
    ``n_words`` and ``n_substituted`` of the overlap, and ``begin`` and ``item_begin`` (word places).
    An overlap counts if it scores ``least``, or three fifths of its item's words if that is less.
    Each mask is used where its own width fits; items shorter than the widest mask are also met as a whole,
    word by word.  Null and empty texts and items have no seeds and match nothing.  item_id names an item, a
    null one too; repeated document rows are reported once.
    """
    widths = [max(mask) + 1 for mask in MASKS]
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words("text").alias("item")).where(
        F.size("item") > 0
    ).distinct()
    short = items.select(F.size("item").alias("n")).where(F.col("n") < max(widths)).distinct()
    lengths = sorted(row.n for row in short.collect())
    width = min(widths + lengths)
    seeds = items.select("item_id", "item", F.explode(F.expr(f"sequence(0, size(item) - {width})")).alias("item_at"))
    seeds = seeds.select("item_id", "item_at", F.explode(_seeds("item", "item_at", lengths, whole=True)).alias("seed"))
    seeds = seeds.where("seed is not null")
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)

    texts = documents.select(*row_key(documents), F.col("doc_id").cast("long").alias("doc_id"), "text")
    worded = texts.select("key", "text_key", _words("text").alias("words")).where(F.size("words") >= width)
    placed = worded.select("*", F.explode(F.expr(f"sequence(0, size(words) - {width})")).alias("at"))
    hits = placed.select("key", "text_key", "at", F.explode(_seeds("words", "at", lengths)).alias("seed")).join(seeds, "seed")
    # hits on one diagonal are one candidate; words stay behind until it is clear which texts are needed
    hits = hits.select("key", "text_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    named = items.withColumnRenamed("item_id", "name")
    laid = hits.join(named, hits["item_id"].eqNullSafe(named["name"])).groupBy("key", "text_key").agg(
        F.collect_set(F.struct("item_id", "shift", "item")).alias("laid")
    )
    tried = texts.dropDuplicates(["key", "text_key"]).join(laid, ["key", "text_key"]).select(
        "key", "text_key", "doc_id", "laid", _words("text").alias("words")
    )

    def run(one: Column) -> Column:
        """The document along an item: word k of the item falls on word shift + k."""
        agree = F.transform(
            one["item"], lambda word, k: F.coalesce(F.get(F.col("words"), one["shift"] + k) == word, F.lit(False))
        )
        return F.struct(
            one["item_id"].alias("item_id"), one["shift"].alias("shift"), F.size(one["item"]).alias("item_words"),
            _best_run(agree, cost).alias("run"),
        )

    scored = tried.select("key", "text_key", "doc_id", F.transform("laid", run).alias("runs"))
    scored = scored.select("key", "text_key", "doc_id", F.explode("runs").alias("r")).select("key", "text_key", "doc_id", "r.*")
    enough = scored.where((F.col("run.score") >= least) | (5 * F.col("run.score") >= 3 * F.col("item_words")))
    found = enough.groupBy("key", "text_key", "item_id").agg(
        F.max(F.struct("run.score", (-F.col("shift")).alias("back"), "run.begin", "run.end", "doc_id")).alias("best")
    )
    words = F.col("best.end") - F.col("best.begin")
    return found.select(
        F.col("best.doc_id").alias("doc_id"), "key", "text_key", "item_id", F.col("best.score").alias("score"),
        words.alias("n_words"), ((words - F.col("best.score")) / (1 + cost)).cast("int").alias("n_substituted"),
        (F.col("best.begin") - F.col("best.back")).alias("begin"), F.col("best.begin").alias("item_begin"),
    )


def _words(text: str) -> Column:
    """Hashes of the words of a text."""
    parts = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(parts, lambda word: F.xxhash64(word))


def _seeds(words: str, at: str, lengths: list[int], whole: bool = False) -> Column:
    """One seed for each mask, from the words at its places, and one for each length of a short item, from all its words.

    Null where there are too few words; with ``whole``, a short item's seed is of all the words there are.
    """
    room = F.size(words) - F.col(at)

    def seed(number: int, places, fits: Column) -> Column:
        return F.when(fits, F.xxhash64(F.lit(number), *(F.get(words, F.col(at) + place) for place in places)))

    masked = [seed(number, mask, room > max(mask)) for number, mask in enumerate(MASKS)]
    return F.array(*masked, *(seed(-n, range(n), (room == n) & (F.size(words) == n) if whole else room >= n) for n in lengths))


def _best_run(agree: Column, cost: int) -> Column:
    """The run of words with the highest score, the first and shortest of equals: score, begin, end."""
    start = F.struct(*(F.lit(0).alias(name) for name in ("at", "now", "since", "score", "begin", "end")))

    def step(run: Column, same: Column) -> Column:
        now = F.greatest(F.lit(0), run["now"]) + F.when(same, 1).otherwise(-cost)
        since = F.when(run["now"] > 0, run["since"]).otherwise(run["at"])
        better = now > run["score"]
        return F.struct(
            (run["at"] + 1).alias("at"), now.alias("now"), since.alias("since"),
            F.when(better, now).otherwise(run["score"]).alias("score"),
            F.when(better, since).otherwise(run["begin"]).alias("begin"),
            F.when(better, run["at"] + 1).otherwise(run["end"]).alias("end"),
        )

    return F.aggregate(agree, start, step)
