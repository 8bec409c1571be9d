"""Scalar expressions used by the reports and the dated layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first: Column | str, last: Column | str, null_as_empty: bool = False) -> Column:
    """First and last name joined by one space.

    A NULL part makes the result NULL, as Spark's ``concat`` does.  With
    ``null_as_empty`` a NULL part counts as an empty string and the separator stays,
    which is what Postgres' CONCAT returns.
    """
    parts = [_col(first), _col(last)]
    if null_as_empty:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(parts[0], F.lit(" "), parts[1])


def interval_day(iv: Column) -> Column:
    """Day field of a day-time interval (INT)."""
    return F.date_part(F.lit("day"), iv)


def interval_hour(iv: Column) -> Column:
    """Hour field of a day-time interval (TINYINT), what is left after whole days."""
    return F.date_part(F.lit("hour"), iv)


def whole_hours(end: Column | str, start: Column | str) -> Column:
    """Whole hours from ``start`` to ``end``, truncated toward zero, as BIGINT."""
    iv = _col(end) - _col(start)
    return (interval_day(iv) * 24 + interval_hour(iv)).cast("bigint")


def starts_with_any_case(c: Column | str, prefix: str) -> Column:
    """Case-insensitive prefix test; ``%`` and ``_`` in the prefix are literal."""
    return _col(c).ilike(_like_literal(prefix) + "%")


def contains_text(c: Column | str, text: str) -> Column:
    """Case-sensitive substring test."""
    return _col(c).contains(text)


def _like_literal(text: str) -> str:
    return "".join("\\" + ch if ch in "%_\\" else ch for ch in text)


def bucket_label(branches: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Searched CASE: the label of the first branch that holds, else ``otherwise``."""
    (cond, label), *rest = branches
    expr = F.when(cond, F.lit(label))
    for cond, label in rest:
        expr = expr.when(cond, F.lit(label))
    return expr if otherwise is None else expr.otherwise(F.lit(otherwise))


def value_or_null(cond: Column, value: Column | str) -> Column:
    """``value`` where ``cond`` holds, else NULL."""
    return F.when(cond, _col(value))


def date_parts(d: Column | str) -> dict[str, Column]:
    """Zero-padded ``year`` / ``month`` / ``day`` strings of an ISO date string or date."""
    day = _col(d).cast("date")
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }
