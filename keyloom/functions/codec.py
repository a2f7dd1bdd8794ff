"""Column expressions on cell values: text <-> UTF-8 bytes, and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp text format of enriched date columns.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def encode_text(value: Column) -> Column:
    """UTF-8 bytes of a string."""
    return F.encode(value, "UTF-8")


def decode_text(value: Column) -> Column:
    """String held in UTF-8 bytes.

    Malformed bytes become U+FFFD. ``decode`` would fail the whole job on the
    first bad byte.
    """
    return F.make_valid_utf8(value.cast("string"))


def as_text(value: Column, data_type: str) -> Column:
    """A column of the named type as string: bytes are decoded, anything else is cast."""
    return decode_text(value) if data_type == "binary" else value.cast("string")


def format_datetime(value: Column, fmt: str = DATETIME_FORMAT) -> Column:
    """Date text in ``fmt``; unreadable text gives null instead of an ANSI error."""
    return F.date_format(value.try_cast("timestamp_ntz"), fmt)
