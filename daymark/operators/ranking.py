"""Sorting, top-n and ranking.

``rank()`` over a whole result is a window without partitions and runs in one task.  Here
the windows see values of the ranked column, not rows, each a range of them: rows that tie stay
where they are and the rank is joined back to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FAN_OUT = 32
_BROADCAST_ROWS = 100_000


def descending(name: str, nulls: str = "last") -> Column:
    """Descending sort key.  ``nulls="first"`` gives Postgres' order."""
    c = F.col(name)
    return c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last()


def ascending(name: str, nulls: str = "first") -> Column:
    """Ascending sort key.  ``nulls="last"`` gives Postgres' order."""
    c = F.col(name)
    return c.asc_nulls_last() if nulls == "last" else c.asc_nulls_first()


def top_n(df: DataFrame, order: Sequence[Column], n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows in the given order.

    Each task keeps at most ``n`` rows before they are merged.  Name columns that make the
    order total in ``tie_break``; without them equal rows at the cut are arbitrary.
    """
    return df.orderBy(*order, *[F.col(c).asc() for c in tie_break]).limit(n)


def _attach(df: DataFrame, ranks: DataFrame, keys: list[str], as_: str) -> DataFrame:
    """Join ranks back; NULL metrics and NULL partitions match each other."""
    right = ranks.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(as_))
    cond = None
    for k in keys:
        eq = df[k].eqNullSafe(right[f"_r_{k}"])
        cond = eq if cond is None else cond & eq
    return df.join(right, cond).drop(*[f"_r_{k}" for k in keys])


def with_rank(df: DataFrame, metric: str, as_: str = "r", nulls: str = "last") -> DataFrame:
    """Add ``RANK() OVER (ORDER BY metric DESC)`` over the whole frame, for a metric of any type.

    The distinct values are dealt into as many equal ranges as a shuffle has partitions.  A value's
    rank is one more than the rows in higher ranges, a prefix sum over one count for each range, and the
    rows of higher values in its own range, a window within the range.  No task sees all values.
    """
    values = df.groupBy(metric).agg(F.count(F.lit(1)).alias("_n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    above = ranges + _FAN_OUT if nulls == "first" else -1
    place = F.when(F.col(metric).isNull(), F.lit(above)).otherwise(_range_of(F.col(metric), F.col("_bounds")))
    placed = values.withColumn("_bounds", _bounds(values, metric, ranges)).withColumn("_range", place).drop("_bounds")
    counts = placed.groupBy("_range").agg(F.sum("_n").alias("_rows"))  # a row for each range
    higher = _sum_before("_rows", Window.orderBy(F.desc("_range"))).alias("_higher")
    within = _sum_before("_n", Window.partitionBy("_range").orderBy(descending(metric, nulls)))
    ranks = placed.withColumn("_within", within).join(F.broadcast(counts.select("_range", higher)), "_range")
    return _attach(df, ranks.select(metric, (F.col("_higher") + F.col("_within") + 1).alias(as_)), [metric], as_)


def _sum_before(name: str, window) -> Column:
    before = F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0).cast("bigint"))


def _bounds(values: DataFrame, metric: str, ranges: int) -> Column:
    """The greatest value of each of ``ranges`` equal ranges, in order, ``_FAN_OUT`` to an array: one scalar."""
    known = values.select(metric).filter(F.col(metric).isNotNull()).repartitionByRange(ranges, metric)
    tops = known.groupBy(F.spark_partition_id()).agg(F.max(metric).alias("_top"))
    tops = tops.agg(F.sort_array(F.collect_list("_top")).alias("_all"))
    starts = F.expr(f"sequence(1, greatest(size(_all), 1), {_FAN_OUT})")
    return tops.select(F.transform(starts, lambda i: F.slice("_all", i, _FAN_OUT))).scalar()


def _range_of(value: Column, bounds: Column) -> Column:
    """How many bounds a value exceeds, found among the last of each array and then within one."""
    full = F.size(F.filter(bounds, lambda some: F.element_at(some, -1) < value))
    rest = F.coalesce(F.size(F.filter(F.get(bounds, full), lambda bound: bound < value)), F.lit(0))
    return full * _FAN_OUT + F.greatest(rest, F.lit(0))


def rank_at_most(
    df: DataFrame,
    metric: str,
    k: int,
    partition: str | Sequence[str] = (),
    as_: str | None = "r",
    nulls: str = "last",
) -> DataFrame:
    """Rows whose descending RANK by ``metric`` is at most ``k``, all ties included.

    Only the metrics of the first ``k`` rows (per partition) can have such a rank, and the
    rows ahead of them are all among those ``k``.  So the window runs on ``k`` rows, and
    the ranks it gives their values are joined back to all rows with these values (and left
    out again if ``as_`` is None).  Any number of rows may tie; they are never brought into one task, and what
    ``df`` shuffles is shuffled once for both.  With partitions, each
    task keeps ``k`` rows of a partition before the shuffle as long as ``k`` is within
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000).
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    order = descending(metric, nulls)
    w = Window.partitionBy(*parts).orderBy(order)
    if parts:
        first = df.select(*parts, metric).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    else:
        first = df.select(metric).orderBy(order).limit(k)
    rank = as_ or "_rank"
    ranks = first.select(*parts, metric, F.rank().over(w).cast("bigint").alias(rank)).distinct()
    if not parts and k <= _BROADCAST_ROWS:
        ranks = F.broadcast(ranks)  # at most k rows by the limit above, whatever the data
    found = _attach(df, ranks, [*parts, metric], rank)
    return found if as_ else found.drop(rank)


def best_per_group(
    df: DataFrame, partition: str | Sequence[str], order: Sequence[Column], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The first row of each group in the given order.

    ``row_number() = 1`` lets Spark keep one row per group in every task before the
    shuffle, so a group with a large share of the rows does not travel whole.
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    w = Window.partitionBy(*parts).orderBy(*order, *[F.col(c).asc() for c in tie_break])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
