"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Two lines are near if one becomes the other by at most one edit of a unit: one put in, left out
or replaced.  The units are words and, between two lines of few words, characters.  Every line emits the
hashes of itself and of all its variants with one unit left out; near lines share one of these.  A line
that has an earlier near line in the corpus goes.  Below, what is said of words holds for either unit.

Only distinct lines are compared, in three steps:

1. Halves.  With one edit, either the first or the last half of the words is untouched, so
   only lines that share a half with another distinct line can be near one; only these emit variants.
2. Variants.  A line emits those without a word outside the half it shares, and lines with equal variants
   meet by hash.  Of each group only the earliest matters, so groups are aggregated, never paired: a hot
   group costs as much as its rows.
3. Verification.  The words of a line and of the earlier line it met are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import row_key, shared_folder, staged

_SPACE = r"[\x20\x09-\x0D]+"


def drop_near_lines(
    documents: DataFrame, least_words: int = 1, near_words: int = 4, carry: tuple[str, ...] = ()
) -> DataFrame:
    """All rows of ``documents`` with the lines that an earlier near line makes superfluous removed.

    Returns ``key``, ``text_key`` (the row), ``doc_id``, ``n_lines``, ``n_removed``, ``kept`` (the other
    lines, joined by line breaks; null for a null text) and ``carried``, a struct of the columns in ``carry``.  Order is by doc_id (null
    first) and line.  Lines with fewer than ``least_words`` words always stay; one edit of a word is
    allowed where the longer line has ``near_words`` words, one of a character where both have fewer words and
    the longer has ``near_words`` characters, else lines must have equal words.  White space
    within lines counts as one blank.  Lines are judged on the input: an earlier line
    counts even if it goes itself.  Rows with the same doc_id and line are in the order of a hash of their
    texts; lines of equal rows share a fate.
    """
    spark = documents.sparkSession
    folder = shared_folder(spark, "lines")
    carried = F.struct(F.lit(None).alias("none"), *(documents[name] for name in carry)).alias("carried")
    texts = documents.select(*row_key(documents), F.col("doc_id").cast("long").alias("doc_id"), "text", carried)
    placed = texts.select("key", "text_key", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    # a filter on the words would be pushed below them and split every line twice
    worded = placed.where(F.col("content").rlike(r"[^\x20\x09-\x0D]")) if least_words > 0 else placed
    hashed = worded.select("key", "text_key", "line", _words("content").alias("words"), "content").withColumn("n", F.size("words"))
    hashed = hashed.where(F.col("n") >= least_words) if least_words > 1 else hashed
    hashed = hashed.withColumn("chars", F.when(F.col("n") < near_words, _chars("content")))
    lines = staged(
        hashed.select(
            "key", "text_key", "line", *_name("words"), _halves("words", near_words).alias("word_halves"),
            F.when(F.col("n") < near_words, _halves("chars", near_words)).alias("char_halves"),
        ),
        folder, "lines",
    )

    place = F.struct("key", "line", "text_key")
    distinct = staged(
        lines.groupBy("h1", "h2").agg(
            F.min(place).alias("first"), F.count("*").alias("copies"),
            *(F.min(F.get(f"{unit}_halves", F.lit(i))).alias(f"{unit}_half{i}") for unit in ("word", "char") for i in range(4)),
        ),
        folder, "distinct",
    )
    row = F.struct(F.col("first.key").alias("key"), F.col("first.line").alias("line"), _short("first.text_key").alias("short"))
    sides = F.array(*(
        F.struct(F.col(f"{unit}_half{i}").alias("half"), F.lit(i % 2).alias("last"), F.lit(unit == "char").alias("chars"))
        for unit in ("word", "char") for i in range(4)
    ))
    halves = distinct.select(
        row.alias("row"), F.explode(F.array_distinct(F.filter(sides, lambda side: side["half"].isNotNull()))).alias("side")
    ).select("row", "side.*")
    line = F.struct(F.col("row.line").alias("line"), "chars")
    shared = staged(halves.groupBy("half").agg(F.count("*").alias("k")).where("k > 1").select("half"), folder, "halves")
    by_row = halves.join(shared, "half").groupBy("row.key", "row.short").agg(
        F.collect_set(F.when(F.col("last") == 0, line)).alias("firsts"),
        F.collect_set(F.when(F.col("last") == 1, line)).alias("lasts"),
    )

    def sharing(lines: Column, first: bool, last: bool) -> Column:
        return F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["chars"].alias("chars"), F.lit(first).alias("first"), F.lit(last).alias("last")))

    by_row = by_row.select(
        "key", "short",
        F.concat(
            sharing(F.array_except("firsts", "lasts"), True, False), sharing(F.array_except("lasts", "firsts"), False, True),
            sharing(F.array_intersect("firsts", "lasts"), True, True),
        ).alias("lines"),
    )
    candidates = (
        texts.select("key", "text_key", "text", _short("text_key").alias("short")).join(by_row, ["key", "short"])
        .dropDuplicates(["key", "short", "text_key"])
        .select("key", "text_key", F.split("text", "\n").alias("all"), F.explode("lines").alias("shared"))
        .select("key", "text_key", "shared.*", F.get("all", F.col("shared.line")).alias("content"))
        .select(
            F.struct("key", "line", "text_key", "chars").alias("place"), "first", "last",
            F.when(F.col("chars"), _chars("content")).otherwise(_words("content")).alias("words"),
        )
    )
    candidates = staged(candidates.select("place", "first", "last", "words"), folder, "candidates")
    earlier = _earlier_near(candidates, near_words, folder).select(
        F.struct("place.key", "place.line", "place.text_key").alias("place")
    ).distinct()

    gone = distinct.join(earlier, distinct["first"] == earlier["place"], "left").select(
        "h1", "h2", "first", "copies", F.col("place").isNotNull().alias("near"),
    )
    gone = staged(gone.where("near or copies > 1").select("h1", "h2", "first", "near"), folder, "gone")
    removed = (
        lines.select("key", "text_key", "line", "h1", "h2").join(gone, ["h1", "h2"])
        .where("near or first < struct(key, line, text_key)")
        .groupBy("key", "text_key").agg(F.collect_set("line").alias("removed"))
    )
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.coalesce("removed", F.array().cast("array<int>")), i))
    return texts.join(removed, ["key", "text_key"], "left").select(
        "key", "text_key", "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("kept"), "carried",
    )


def _short(text_key: str) -> Column:
    """Half of a text's hash; with a doc_id it still tells rows apart."""
    return F.shiftright(F.col(text_key), 32).cast("int")


def _words(line: str) -> Column:
    """Hashes of the words of a line."""
    return F.transform(_split(line), lambda word: F.xxhash64(word))


def _chars(line: str) -> Column:
    """Hashes of the characters of a line's words, one blank between two; never those of words."""
    joined = F.split(F.array_join(_split(line), " "), "")
    return F.transform(F.filter(joined, lambda char: char != ""), lambda char: F.xxhash64(F.lit("char"), char))


def _split(line: str) -> Column:
    return F.filter(F.split(line, _SPACE), lambda word: word != "")


def _name(words: str) -> list[Column]:
    """128 bits that name a line's words."""
    return [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit("line"), F.col(words)).alias("h2")]


def _halves(words: str, near_words: int) -> Column:
    """The halves that a line shares with every near line of its length, one word longer or one shorter.

    Whichever line is shorter sets the length of the halves: half its own words, or half of
    one word less if it is the longer one.
    """
    w = F.col(words)
    size = F.size(w)

    def sides(half: Column) -> list[Column]:
        return [
            F.xxhash64(F.lit("first"), half, F.slice(w, F.lit(1), half)),
            F.xxhash64(F.lit("last"), half, F.slice(w, size - half + 1, half)),
        ]

    own, less = F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")
    return F.when(size >= near_words - 1, F.array(*sides(own), *sides(less)))


def _earlier_near(candidates: DataFrame, near_words: int, folder: str) -> DataFrame:
    """``place`` of every candidate line that has an earlier line one edit away; its last field tells the unit."""
    n = F.size("words")
    less = F.floor((n - 1) / 2).cast("int")
    # where a half is shared, the edit is outside it
    outs = F.sequence(F.when(F.col("last"), F.lit(1)).otherwise(less + 1), F.when(F.col("first"), n).otherwise(n - less))
    left_out = F.transform(
        outs,
        lambda i: F.struct(
            i.alias("out"),
            F.xxhash64(F.concat(F.slice("words", F.lit(1), i - 1), F.slice("words", i + 1, n))).alias("variant"),
        ),
    )
    variants = candidates.where(n >= near_words).select("place", F.explode(left_out).alias("v")).select(
        "place", F.col("v.out").alias("out"), F.col("v.variant").alias("variant")
    )
    variants = staged(variants, folder, "variants")
    selves = candidates.where(n >= near_words - 1).select(F.col("place").alias("whole"), F.xxhash64("words").alias("variant"))

    # most variants meet nothing: hashes alone are counted first, and what is alone goes
    crowded = variants.select("variant").unionByName(selves.select("variant")).groupBy("variant").agg(F.count("*").alias("k"))
    crowded = staged(crowded.where("k > 1").select("variant"), folder, "crowded")
    variants = staged(variants.join(crowded, "variant"), folder, "met_variants")

    # replaced: both lines without their word at the same place
    replaced = variants.groupBy("variant", "out").agg(F.min("place").alias("earlier"), F.count("*").alias("k")).where("k > 1")
    replaced = staged(replaced.select("variant", "out", "earlier"), folder, "replaced")
    met = variants.join(replaced, ["variant", "out"]).where("earlier < place").select(
        "place", "earlier", F.col("out").alias("out_place"), F.col("out").alias("out_earlier")
    )
    # left out: the line without a word is another line as it is
    shorter = variants.join(selves, "variant").where("whole <> place")
    shorter = staged(shorter.select("variant", "place", "whole", "out"), folder, "shorter")
    met = met.unionByName(
        shorter.where("whole < place").select(
            "place", F.col("whole").alias("earlier"), F.col("out").alias("out_place"), F.lit(0).alias("out_earlier")
        )
    )
    # put in: the other way round; the earliest of the longer lines will do
    longer = shorter.groupBy("whole").agg(F.min(F.struct("place", "out")).alias("least")).select(
        F.col("whole").alias("place"), F.col("least.place").alias("earlier"), F.lit(0).alias("out_place"),
        F.col("least.out").alias("out_earlier"),
    )
    met = met.unionByName(longer.where("earlier < place"))
    met = staged(
        met.groupBy("place").agg(F.min(F.struct("earlier", "out_place", "out_earlier")).alias("met")).select("place", "met.*"),
        folder, "met",
    )

    words = candidates.select("place", "words")
    others = candidates.select(F.col("place").alias("earlier"), F.col("words").alias("others"))
    both = met.join(words, "place").join(others, "earlier")
    return staged(both.where(_without("words", "out_place") == _without("others", "out_earlier")).select("place"), folder, "near")


def _without(words: str, out: str) -> Column:
    """The words but the one at ``out``, all of them where that is 0."""
    w, at = F.col(words), F.col(out)
    return F.when(at == 0, w).otherwise(
        F.concat(F.slice(w, F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(w, F.greatest(at + 1, F.lit(1)), F.size(w)))
    )
