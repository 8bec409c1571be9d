"""Joins.

No join carries a broadcast hint here: whether a dimension fits is decided by Spark from
its size (``autoBroadcastJoinThreshold`` at planning, the measured size under AQE), and a
side that has grown past the threshold falls back to a shuffled join whose hot partitions
AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from daymark.operators.aggregates import grouped_for_join
from daymark.operators.sizes import fits_broadcast


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def chain(start: DataFrame, *steps: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Inner equi-joins in sequence; each step is ``(frame, key name or names)``."""
    return reduce(lambda left, step: left.join(step[0], _names(step[1])), steps, start)


def through_bridge(
    items: DataFrame, bridge: DataFrame, others: DataFrame, item: str, other: str
) -> DataFrame:
    """Many-to-many join: one output row per bridge row with both ends present."""
    return chain(bridge, (items, item), (others, other))


def unmatched(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], left_unique: bool = False
) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (same as LEFT JOIN ... IS NULL).

    A right side that must be shuffled is cut to its distinct keys first, so a key
    repeated in a large share of the right rows leaves each map task once.  A key that
    owns a large share of the left rows is split over tasks; ``left_unique`` says that
    there is none, which saves shuffling the distinct keys again.
    """
    names = _names(keys)
    present = right.select(*names)
    if not fits_broadcast(present):
        present = present.distinct() if left_unique else grouped_for_join(present, names)
    return left.join(present, names, "left_anti")
