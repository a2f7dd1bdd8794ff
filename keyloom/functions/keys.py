"""Column expressions on lookup keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """A column by its whole name, which may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one where ``taken`` has it already."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name += "_"
    return name


def text_key(key: Column) -> Column:
    """The key as text, which for a string column is the column itself."""
    return key.cast("string")


def has_key(key: Column) -> Column:
    """True for a usable lookup key, false for null and for the empty string."""
    return key.isNotNull() & (text_key(key) != "")


def no_key(key: Column) -> Column:
    """Complement of :func:`has_key`; never null, so the two split a table exactly."""
    return key.isNull() | (text_key(key) == "")


def nullif_empty(key: Column) -> Column:
    """The key itself, or null where there is none."""
    return F.when(text_key(key) != "", key)
