"""The seven reports as shapes over any schema; column roles are named by the caller.

Join keys have the same name on both sides, so a caller renames columns (free in Spark)
and passes frames that hold just the roles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import whole_hours
from daymark.operators import (
    Hop,
    best_per_group,
    carry_totals,
    descending,
    rank_at_most,
    top_n,
    unmatched,
)


def items_per_label(
    items: DataFrame,
    links: DataFrame,
    hops: Sequence[Hop],
    item: str,
    label_as: str,
    count_as: str,
    nulls: str = "last",
) -> DataFrame:
    """Linked items per label, most first.

    ``links`` joins items to the key of the first hop, and the hops lead from there to the
    label (``carry_totals``).  An item counts once per link.
    """
    first_key = hops[0].key
    linked = links.select(item, first_key).join(items.select(item), item)
    ones = linked.select(first_key, F.lit(1).cast("bigint").alias(count_as))
    totals = carry_totals(ones, count_as, hops)
    named = totals.select(F.col(hops[-1].to).alias(label_as), count_as)
    return named.orderBy(descending(count_as, nulls), label_as)


def busiest_people(counts: DataFrame, name: str, count: str, n: int, nulls: str = "last") -> DataFrame:
    """The ``n`` names with the highest counts; equal counts in name order."""
    return top_n(counts.select(name, count), [descending(count, nulls)], n, tie_break=[name])


def people_in_top_ranks(counts: DataFrame, name: str, count: str, k: int, nulls: str = "last") -> DataFrame:
    """Names whose count ranks at most ``k``, with all ties."""
    return rank_at_most(counts.select(name, count), count, k, as_=None, nulls=nulls)


def highest_total_label(
    facts: DataFrame,
    amount: str,
    hops: Sequence[Hop],
    label_as: str,
    total_as: str,
    nulls: str = "last",
) -> DataFrame:
    """The label with the highest total; a fact that leads to several labels counts in each."""
    totals = carry_totals(facts, amount, hops)
    named = totals.select(F.col(hops[-1].to).alias(label_as), F.col(amount).alias(total_as))
    return top_n(named, [descending(total_as, nulls)], 1, tie_break=[label_as])


def titles_without_stock(items: DataFrame, stock: DataFrame, item: str, title: str) -> DataFrame:
    """Titles of items with no stock row, one per item (``item`` is the items' key)."""
    return unmatched(items.select(item, title), stock, item, left_unique=True).select(title)


def conditional_counts_per_label(
    facts: DataFrame,
    value: str,
    conditions: dict[str, Column],
    hops: Sequence[Hop],
    label_as: str,
    order_by: str,
    nulls: str = "last",
) -> DataFrame:
    """Side-by-side conditional counts per label; labels of no fact are absent."""
    hits = [
        F.when(cond & F.col(value).isNotNull(), 1).otherwise(0).cast("bigint").alias(name)
        for name, cond in conditions.items()
    ]
    totals = carry_totals(facts.select(hops[0].key, *hits), list(conditions), hops)
    named = totals.select(F.col(hops[-1].to).alias(label_as), *conditions)
    return named.orderBy(descending(order_by, nulls), label_as)


def hours_of(spans: DataFrame, end: str, start: str, hours_as: str) -> DataFrame:
    """``spans`` with the whole hours of each row in place of its two timestamps."""
    return spans.withColumn(hours_as, whole_hours(end, start)).drop(end, start)


def busiest_label_per_bucket(
    spans: DataFrame, bucket: str, label: str, hours: str, nulls: str = "last"
) -> DataFrame:
    """Per bucket, the label with the highest hour total; equal totals go to the first label."""
    totals = spans.groupBy(bucket, label).agg(F.sum(hours).alias(hours))
    return best_per_group(totals, bucket, [descending(hours, nulls)], tie_break=[label])
