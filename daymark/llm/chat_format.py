"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all turns up to it as context, and only its
text trainable.  Turns after the last assistant turn make one more example without a
trainable part, so that the examples hold whole conversations.  A turn is written as

    <turn role>
    text
    </turn>

with ``\\``, ``<`` and ``>`` of roles and texts written as ``\\b``, ``\\l`` and ``\\g``, so no text can hold a
marker, and texts can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control characters and how they are written; to read back, in reverse order.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
_OPEN, _MIDDLE, _CLOSE = "<turn ", ">\n", "\n</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example`` (from 1), ``n_examples``, ``formatted``, ``loss_start``, ``loss_end``.

    The trainable span is in code points of ``formatted``, end exclusive; null in an example that has
    none.  Rows are turns in the order of ``turn`` (null first; ties by role and text, repeated rows
    are turns of their own).  Null texts and roles are empty.  A null conv_id is one conversation.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = turns.select(
        "conv_id",
        F.transform(
            "turns", lambda t: F.concat(F.lit(_OPEN), escape(t["role"]), F.lit(_MIDDLE), escape(t["text"]), F.lit(_CLOSE))
        ).alias("written"),
        F.transform("turns", lambda t: t["role"] == "assistant").alias("replies"),
        F.transform("turns", lambda t: F.char_length(escape(t["text"]))).alias("lengths"),
    )
    places = F.filter(
        F.sequence(F.lit(1), F.size("replies")), lambda i: F.get("replies", i - 1) | (i == F.size("replies"))
    )
    examples = written.select(
        "conv_id", "written", "replies", "lengths", F.size(places).alias("n_examples"), F.posexplode(places).alias("number", "upto")
    )
    formatted = examples.select(
        "conv_id", (F.col("number") + 1).alias("example"), "n_examples",
        F.array_join(F.slice("written", F.lit(1), F.col("upto")), "").alias("formatted"),
        F.get("replies", F.col("upto") - 1).alias("trained"), F.get("lengths", F.col("upto") - 1).alias("length"),
    )
    end = F.char_length("formatted") - len(_CLOSE)
    return formatted.select(
        "conv_id", "example", "n_examples", "formatted",
        F.when(F.col("trained"), end - F.col("length")).alias("loss_start"), F.when(F.col("trained"), end).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example: an array of role and text."""
    pieces = F.filter(F.split(formatted, _CLOSE), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, _MIDDLE, 1)
        return F.struct(
            unescape(F.substr(role, F.lit(len(_OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.char_length(role) + len(_MIDDLE) + 1)).alias("text"),
        )

    return F.transform(pieces, turn)


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example; null if there is none."""
    return unescape(F.substr(formatted, start + 1, end - start))


def read_back(examples: DataFrame) -> DataFrame:
    """Each conversation as its examples give it back: ``conv_id``, ``turns``, ``losses`` (in order), ``formatted_chars``."""
    last = F.col("example") == F.col("n_examples")
    parts = examples.select(
        "conv_id", "example", F.char_length("formatted").alias("chars"), F.when(last, read_turns(F.col("formatted"))).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
    )
    joined = parts.groupBy("conv_id").agg(
        F.flatten(F.collect_list("turns")).alias("turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
    )
    return joined.select("conv_id", "turns", F.transform("losses", lambda x: x["loss"]).alias("losses"), "formatted_chars")
