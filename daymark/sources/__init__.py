"""Reads: relational tables, CSV and JSON zones, Parquet, and the catalog."""

from daymark.sources.feed import FEED_SCHEMA, feed_slice, read_feed_file, read_landed_feed, reject_empty_records
from daymark.sources.files import read_csv, read_csv_raw, read_json_inferred, read_parquet
from daymark.sources.relational import discover_tables, read_table
from daymark.sources.tables import TableSpec, for_each_table, register_views

__all__ = [
    "FEED_SCHEMA",
    "TableSpec",
    "discover_tables",
    "feed_slice",
    "for_each_table",
    "read_csv",
    "read_csv_raw",
    "read_feed_file",
    "read_json_inferred",
    "read_landed_feed",
    "read_parquet",
    "read_table",
    "register_views",
    "reject_empty_records",
]
