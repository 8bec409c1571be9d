"""DataFrame -> DataFrame operators."""

from daymark.operators.aggregates import (
    Hop,
    carry_totals,
    count_by_condition,
    count_distinct_by,
    count_distinct_through,
    drop_duplicate_rows,
    grouped_for_join,
)
from daymark.operators.joins import chain, through_bridge, unmatched
from daymark.operators.ranking import (
    ascending,
    best_per_group,
    descending,
    rank_at_most,
    top_n,
    with_rank,
)

__all__ = [
    "Hop",
    "ascending",
    "best_per_group",
    "carry_totals",
    "chain",
    "count_by_condition",
    "count_distinct_by",
    "count_distinct_through",
    "descending",
    "drop_duplicate_rows",
    "grouped_for_join",
    "rank_at_most",
    "through_bridge",
    "top_n",
    "unmatched",
    "with_rank",
]
