"""Column -> Column helpers.  All are built-in expressions and stay inside codegen."""

from daymark.functions.scalars import (
    bucket_label,
    contains_text,
    date_parts,
    full_name,
    interval_day,
    interval_hour,
    starts_with_any_case,
    value_or_null,
    whole_hours,
)

__all__ = [
    "bucket_label",
    "contains_text",
    "date_parts",
    "full_name",
    "interval_day",
    "interval_hour",
    "starts_with_any_case",
    "value_or_null",
    "whole_hours",
]
