"""Writes.  Every function states its mode and returns the number of rows written."""

from daymark.sinks.audit import Written, audited, content_sum, counted_content, observed
from daymark.sinks.files import (
    append_parquet,
    land_json_by_date,
    overwrite_parquet,
    snapshot_path,
    upsert_dates,
    write_csv_snapshot,
    clear_dates,
    land_dates,
    write_by_day,
    write_by_run_date,
    write_csv_day,
)
from daymark.sinks.relational import append_table, load_table, overwrite_table
from daymark.sinks.warehouse import FolderWarehouse

__all__ = [
    "FolderWarehouse",
    "Written",
    "append_parquet",
    "append_table",
    "audited",
    "content_sum",
    "counted_content",
    "land_json_by_date",
    "load_table",
    "observed",
    "overwrite_parquet",
    "overwrite_table",
    "snapshot_path",
    "upsert_dates",
    "clear_dates",
    "land_dates",
    "write_by_day",
    "write_by_run_date",
    "write_csv_day",
    "write_csv_snapshot",
]
