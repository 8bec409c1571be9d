"""Size checks made while a plan is built."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is within its broadcast threshold.

    Then a join with it is planned without a shuffle.  The estimate comes from file sizes
    and the columns read; joins inside ``df`` make it larger, never smaller.
    """
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= threshold


def tasks_by_input(df: DataFrame, bytes_each: int = 4 << 20) -> int:
    """Tasks for the rows of ``df`` that grow with what it reads, by Spark's own estimate of its inputs.

    Sizes of whole files, whatever columns are read; an input of unknown size counts as none.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(1, -(-sum(size for size in sizes if size < 1 << 60) // bytes_each))
