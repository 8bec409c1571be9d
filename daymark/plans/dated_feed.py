"""Daily feed of dated records: land as JSON -> typed silver Parquet -> warehouse.

Every step takes one run date or many; a backfill is one Spark job per step.  All steps
can be repeated for a date: bronze and silver replace that date's directory, the warehouse
replaces that date's rows.  The warehouse is a database or a folder of Parquet tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymark.plans.snapshot import Warehouse
from daymark.sinks import FolderWarehouse, clear_dates, land_dates, load_table, observed
from daymark.sources import FEED_SCHEMA, read_landed_feed, read_parquet, reject_empty_records
from daymark.sources.feed import all_null, is_on, on_dates, run_dates


@dataclass(frozen=True)
class FeedCounts:
    """Rows landed, kept in silver, rejected on the way, and loaded."""

    bronze: int
    silver: int
    rejected: int
    warehouse: int | None = None


def land(feed: DataFrame, bronze: str, dates: str | Sequence[str], date_col: str = "date") -> tuple[int, int]:
    """Land the feed records of the given dates; returns (landed, rejected for want of a date).

    A date without records is empty afterwards, whatever it held before.
    """
    wanted = feed.filter(is_on(dates, date_col) | F.col(date_col).isNull())
    return land_dates(wanted, bronze, dates, date_col)


def refine(
    spark: SparkSession,
    bronze: str,
    silver: str,
    dates: str | Sequence[str],
    schema: StructType = FEED_SCHEMA,
    date_col: str = "date",
    mode: str = "replace",
) -> tuple[int, int]:
    """Typed silver rows of the given dates; returns (written, rejected).

    Rejected are records whose payload is all NULL: an error body that was landed as if it
    were data.  ``mode="append"`` adds to silver instead of replacing the dates, so a
    second run doubles them.
    """
    payload = [f.name for f in schema if f.name != date_col]
    landed = read_landed_feed(spark, bronze, dates, schema, date_col)
    landed = landed.select(*[f.name for f in schema])
    # Counted above the shuffle, in the stage that writes.
    shuffled = landed.hint("rebalance", date_col)

    def write(out: DataFrame) -> None:
        kept = reject_empty_records(out, payload)
        writer = kept.write.partitionBy(date_col)
        if mode == "append":
            writer.mode("append").parquet(silver)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(silver)

    seen = observed(
        shuffled,
        write,
        rows=F.count(F.lit(1)),
        rejected=F.count(F.when(all_null(payload), F.lit(1))),
        present=F.collect_set(F.when(~all_null(payload), F.col(date_col).cast("string"))),
    )
    if mode != "append":  # dates left without a row, and dates of rejected records only
        clear_dates(spark, silver, {d.isoformat() for d in run_dates(dates)} - set(seen["present"]), date_col)
    return seen["rows"] - seen["rejected"], seen["rejected"]


def load(
    spark: SparkSession,
    silver: str,
    warehouse: Warehouse,
    table: str,
    dates: str | Sequence[str],
    date_col: str = "date",
    full_history: bool = False,
) -> int:
    """Load the dates' silver rows, replacing those dates in the warehouse.

    ``full_history`` appends the whole silver table instead, so earlier dates are there
    once per run; in a folder, once for each list of run dates, however often it is run.
    """
    rows = read_parquet(spark, silver)
    if isinstance(warehouse, FolderWarehouse):
        if full_history:
            return warehouse.append(rows, table, "history of " + " ".join(d.isoformat() for d in run_dates(dates)))["rows"]
        return warehouse.replace_dates(on_dates(rows, dates, date_col), table, date_col, dates)["rows"]
    if full_history:
        return load_table(rows, warehouse.url, table, warehouse.properties, replace=False)
    listed = [d.isoformat() for d in run_dates(dates)]
    return load_table(
        on_dates(rows, dates, date_col), warehouse.url, table, warehouse.properties, date_col, listed
    )


def run_dated_feed(
    spark: SparkSession,
    feed: DataFrame,
    dates: str | Sequence[str],
    bronze: str,
    silver: str,
    warehouse: Warehouse | None = None,
    table: str = "out_of_stock",
    schema: StructType = FEED_SCHEMA,
    date_col: str = "date",
    full_history: bool = False,
) -> FeedCounts:
    """Carry the feed of the given dates through the zones; without ``warehouse`` to silver."""
    landed, undated = land(feed, bronze, dates, date_col)
    written, rejected = refine(spark, bronze, silver, dates, schema, date_col)
    loaded = None
    if warehouse is not None:
        loaded = load(spark, silver, warehouse, table, dates, date_col, full_history)
    return FeedCounts(landed, written, rejected + undated, loaded)
