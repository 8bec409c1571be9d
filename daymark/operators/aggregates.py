"""Aggregations, including sums carried along a chain of joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.operators.sizes import fits_broadcast, tasks_by_input


def count_distinct_by(
    df: DataFrame, keys: str | Sequence[str], value: str, as_: str, few_repeats: bool = False
) -> DataFrame:
    """Exact ``COUNT(DISTINCT value)`` per group.

    Spark first removes repeats on (keys, value), shuffled on both, and only then counts,
    so one group that owns a large share of the rows is spread over all tasks.

    ``few_repeats`` says that most pairs of (keys, value) occur once.  Collapsing them before the
    shuffle would hold nearly all rows of a task in memory (twice, where they already lie by
    ``value``), so they are shuffled as they are, into tasks whose number grows with the input.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if few_repeats:
        df = df.select(*names, value).repartition(tasks_by_input(df), *names, value)
    return df.groupBy(*names).agg(F.count_distinct(F.col(value)).alias(as_))


def count_by_condition(
    df: DataFrame, keys: str | Sequence[str], conditions: Mapping[str, Column], value: str
) -> DataFrame:
    """Per group, how many non-NULL ``value`` meet each condition; no hit gives 0."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*names).agg(
        *[F.count(F.when(cond, F.col(value))).alias(name) for name, cond in conditions.items()]
    )


def grouped_for_join(df: DataFrame, keys: str | Sequence[str], *aggs: Column) -> DataFrame:
    """One row per key, laid out so that a following join on the keys shuffles it again.

    AQE splits a hot join partition only where both inputs come straight out of a
    shuffle.  A plain ``groupBy(keys)`` lets the join reuse its partitioning, so a hot key
    on the *other* side would stay in one task.  Grouping on a hash of the keys as well
    changes no group but partitions differently; what is shuffled again is grouped rows.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    spread = df.select("*", F.xxhash64(*names).alias("_spread")).groupBy(*names, "_spread")
    return (spread.agg(*aggs) if aggs else spread.agg(F.lit(1).alias("_one")).drop("_one")).drop("_spread")


def count_distinct_through(
    events: DataFrame, members: DataFrame, group: str, event: str, label: str, as_: str
) -> DataFrame:
    """``COUNT(DISTINCT event)`` per label over ``events`` joined to ``members`` on ``group``.

    Written plainly, that join pairs every event of a group with every member of it.  But
    events that occur in one group only (all of them, where ``event`` is a key) can be
    counted per group first, and a label has the sum over its groups.  The others, and
    NULL events, take the plain way, so the result is the same whatever the data.
    """
    labels = members.select(group, label).distinct()
    placed = events.select(event, group).filter(F.col(group).isNotNull())
    span = placed.groupBy(event).agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    in_one = (F.col("_first") == F.col("_last")) & F.col(event).isNotNull()
    per_group = grouped_for_join(
        span.filter(in_one).select(F.col("_first").alias(group)), group, F.count(F.lit(1)).alias(as_)
    )
    counted = labels.join(per_group, group).groupBy(label).agg(F.sum(as_).alias(as_))

    others = span.filter(~in_one).select(F.col(event).alias("_event"))
    rest = placed.join(others, F.col(event).eqNullSafe(F.col("_event")), "left_semi")
    paired = count_distinct_by(rest.join(labels, group), label, event, as_)
    return counted.unionByName(paired).groupBy(label).agg(F.sum(as_).alias(as_))


class Hop(NamedTuple):
    """One step of ``carry_totals``: meet ``frame`` on ``key``, go on under ``to``.

    ``to`` is ``key`` again if the frame only has to confirm the key.  ``repeats`` says
    that a key may have many rows in ``frame`` (a bridge table), a third of all if need
    be; such a key is then split over tasks.
    """

    frame: DataFrame
    key: str
    to: str
    repeats: bool = False


def carry_totals(
    facts: DataFrame, totals: str | Sequence[str], hops: Sequence[Hop], keep: Sequence[str] = ()
) -> DataFrame:
    """Sum ``totals`` up a chain of inner joins, grouping before each shuffled join.

    The result has one row per value of the last hop's ``to`` (and of ``keep``).  It
    equals joining everything and summing once, fan-out included, because sums split
    freely over rows.  Grouping on the next join key needs the very shuffle the join
    needs, so it costs none of its own; a key that owns a large share of the facts leaves
    each map task as one row, and every later hop carries only groups.  A frame small
    enough to be broadcast is joined as it is: that join shuffles nothing.
    """
    names = [totals] if isinstance(totals, str) else list(totals)
    extra = list(keep)
    types = {f.name: f.dataType for f in facts.agg(*[F.sum(n).alias(n) for n in names]).schema}
    sums = [F.sum(n).alias(n) for n in names]
    out = facts
    for hop in hops:
        keys = [hop.key, *extra]
        steps = hop.frame.select(*dict.fromkeys([hop.key, hop.to]))
        if not fits_broadcast(steps):
            out = grouped_for_join(out, keys, *sums) if hop.repeats else out.groupBy(*keys).agg(*sums)
        out = out.join(steps, hop.key).select(hop.to, *extra, *names)
    # Decimal sums widen at each hop; the result has the type of a single sum.
    final = [F.sum(n).cast(types[n]).alias(n) for n in names]
    return out.groupBy(hops[-1].to, *extra).agg(*final)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows; copies collapse in the map tasks before the shuffle."""
    return df.dropDuplicates()
