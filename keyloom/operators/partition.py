"""Placing rows by lookup key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import has_key, named, no_key, text_key


def split_by_key(df: DataFrame, key: str, hot_keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(cold, free)``: rows to be placed by key, and rows without a key or with a hot one.

    Every row of ``df`` is in exactly one of the two. ``df`` is read once for
    each, so hand in a checkpoint when it is costly or not repeatable.
    """
    column = named(key)
    if not hot_keys:
        return df.where(has_key(column)), df.where(no_key(column))
    hot = text_key(column).isin(list(hot_keys))
    return df.where(has_key(column) & ~hot), df.where(no_key(column) | hot)


def row_hash(df: DataFrame):
    """A hash of all columns that can be hashed, which maps cannot."""
    return F.xxhash64(*[named(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"])


def spreading_salt(df: DataFrame, key: str, hot_keys: Sequence[str] = ()):
    """0 for rows that belong with their key; a hash of all columns for rows without a key or with a hot one.

    Maps cannot be hashed and do not count. A recomputed task gives every row the same salt.
    """
    column = named(key)
    free = no_key(column) | text_key(column).isin(list(hot_keys)) if hot_keys else no_key(column)
    return F.when(free, row_hash(df)).otherwise(F.lit(0).cast("bigint"))


def repartition_by_key(df: DataFrame, key: str, partitions: int, hot_keys: Sequence[str] = ()) -> DataFrame:
    """Hash the rows by key so that equal keys sit together.

    Rows without a key have nothing to sit with, and a hot key would fill one
    task, so both are dealt out by a hash of all their columns. ``df`` is read once,
    and there are exactly ``partitions`` partitions. Maps cannot be hashed and do not
    count; rows that are equal in all other columns stay together.
    """
    return df.repartition(partitions, named(key), spreading_salt(df, key, hot_keys))
