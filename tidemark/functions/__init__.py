"""Column-returning functions. None of them is a UDF."""

from tidemark.functions.filters import between_dates, floor_to_bucket, from_date, in_list, on_dates, until_date
from tidemark.functions.keys import UNKNOWN_ID, surrogate_key, unknown_key
from tidemark.functions.numbers import band, count_where, once, safe_divide
from tidemark.functions.times import (
    as_instant,
    cdc_millis,
    date_key,
    iso_text,
    parse_iso,
    to_instant,
    whole_days,
    whole_seconds,
)
from tidemark.functions.uri import page_type, uri_parts, uri_product_id

__all__ = [
    "UNKNOWN_ID", "as_instant", "band", "between_dates", "cdc_millis", "count_where", "date_key", "floor_to_bucket",
    "from_date", "in_list", "iso_text", "on_dates", "once", "page_type", "parse_iso", "safe_divide", "surrogate_key", "to_instant",
    "unknown_key", "until_date", "uri_parts", "uri_product_id", "whole_days", "whole_seconds",
]
