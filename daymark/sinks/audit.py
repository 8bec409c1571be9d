"""Row counts and content sums taken while writing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, TimestampNTZType, TimestampType

_MICROSECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Written(int):
    """Rows written; ``content`` is their content sum where one was asked for."""

    content: str | None = None

    @classmethod
    def of(cls, seen: dict) -> Written:
        found = cls(seen["rows"])
        found.content = seen.get("content")
        return found


def observed(df: DataFrame, write: Callable[[DataFrame], None], with_content: bool = False, **metrics: Column) -> dict:
    """Write ``df`` and return the metrics of the written rows, by default ``rows``.

    ``with_content`` adds their content sum as ``content``.

    One pass: nothing is read or computed again for the count.  The metrics sit directly
    below the write, in its own stage, where a task that is run again replaces its
    earlier figures; below a shuffle a lost executor could make them count twice.
    """
    wanted = metrics or {"rows": F.count(F.lit(1))}
    seen = Observation()
    if with_content:
        # Metrics are interpreted row by row, so the digest is a column, in generated code, that is not written.
        digest = next(name for name in map("_digest{}".format, range(len(df.columns) + 1)) if name not in {c.lower() for c in df.columns})
        wanted = {**wanted, "content": _summed(F.col(digest))}
        df, given = df.withColumn(digest, row_digest(df)), write
        write = lambda out: given(out.drop(digest))
    write(df.observe(seen, *[expr.alias(name) for name, expr in wanted.items()]))
    return dict(seen.get)


def audited(df: DataFrame, write: Callable[[DataFrame], None], content: bool) -> Written:
    """``observed`` rows, and with ``content`` their content sum, in the same pass."""
    return Written.of(observed(df, write, content, rows=F.count(F.lit(1))))


def content_sum(df: DataFrame) -> Column:
    """An aggregate over all columns of ``df`` that any changed, lost or repeated row changes.

    Each row's text (every value with its length, NULL apart) goes through MD5, and the first 15
    digits of each, as numbers, are added up: order does not matter, and partial sums are all that is
    shuffled.  The result is the sum's decimal text, '0' for no rows.  Other engines compute the same
    from the same texts, as long as they write numbers alike (see ``text_of``).
    """
    return F.coalesce(F.sum(row_digest(df).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("string")


def counted_content(df: DataFrame, rows: str, content: str) -> DataFrame:
    """One row with the number of rows and the content sum of ``df``."""
    digests = df.select(row_digest(df).alias("digest"))
    return digests.agg(F.count(F.lit(1)).alias(rows), _summed(F.col("digest")).alias(content))


def row_digest(df: DataFrame) -> Column:
    """What a row adds to ``content_sum``, a BIGINT of 60 bits."""
    cells = [F.coalesce(_measured(text_of(f"`{f.name}`", f.dataType)), F.lit("~")) for f in df.schema]
    return F.conv(F.substring(F.md5(F.concat(F.lit(""), *cells)), 1, 15), 16, 10).cast("bigint")


def _summed(digest: Column) -> Column:
    """The sum of digests as text, from sums of 20 bits each, which stay numbers for 2**43 rows."""
    total = F.lit(0).cast("decimal(38,0)")
    for low in (40, 20, 0):
        part = F.sum(F.shiftright(digest, low).bitwiseAND(F.lit(2**20 - 1))).cast("decimal(20,0)")
        total = (total + part * F.lit(2**low).cast("decimal(13,0)")).cast("decimal(38,0)")
    return F.coalesce(total, F.lit(0).cast("decimal(38,0)")).cast("string")


def text_of(name: str, kind: DataType) -> Column:
    """A value as text, NULL for NULL: times with microseconds, bytes as hex, nested values as JSON, all else as cast."""
    c = F.col(name)
    if isinstance(kind, StringType):
        return c
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.date_format(c, _MICROSECONDS)
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if hasattr(kind, "fields") or hasattr(kind, "elementType") or hasattr(kind, "keyType"):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def _measured(text: Column) -> Column:
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)
