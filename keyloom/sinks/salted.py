"""Main tables bucketed by lookup key whose hot and keyless rows are spread over the buckets.

A salted table has the column ``key_salt``, and is bucketed by key and salt. Rows of
ordinary keys have salt 0; those of a hot key as many salts as its share of the rows asks for.
Beside it, ``<table>_hot`` lists the hot keys and their numbers of salts.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.keys import free_name, has_key, named, no_key, text_key
from keyloom.operators.keyjoin import StoredSalt, salt_copies
from keyloom.operators.lookup import Field, lookup_enrich
from keyloom.operators.partition import row_hash
from keyloom.plans.skew import LEAST_SHARE, key_shares

SALT = "key_salt"
# Salts to an average bucket: salts are hashed to buckets, so many small ones fill them evenly.
_SALTS = 32


def save_salted(main: DataFrame, table: str, buckets: int, key: str, *, path: str | None = None) -> None:
    """``main`` as a table of ``buckets`` files of about the same size, whatever its keys.

    A key that fills a quarter of an average bucket is hot; beyond 2500 buckets, one with a
    ten-thousandth of the rows. Rows of hot keys and rows without a key go to salts by a hash of their
    columns, so a task that is run again deals them alike; rows that are equal in all columns stay together. One job before the
    write finds hot keys, of which there are 10,000 at most. An existing table is an error.
    """
    if buckets < 1:
        raise ValueError(f"buckets must be at least 1, got {buckets}")
    if SALT in main.columns:
        raise ValueError(f"{SALT} is a column of the rows")
    spark = main.sparkSession
    shares = key_shares(main, key, min(1.0, max(LEAST_SHARE, 1 / (4 * buckets))))
    hot = spark.createDataFrame([(k, _salts(s, buckets)) for k, s in sorted(shares.shares.items())], "hot_key string, salts bigint")
    _writer(hot.coalesce(1), None if path is None else f"{path}_hot").saveAsTable(f"{table}_hot")

    hot_key, salts = free_name(main.columns, "__hot_key"), free_name(main.columns, "__salts")
    listed = spark.table(f"{table}_hot").select(F.col("hot_key").alias(hot_key), F.col("salts").alias(salts))
    of_row = F.when(no_key(named(key)), F.lit(_salts(shares.keyless, buckets))).otherwise(F.coalesce(F.col(salts), F.lit(1)))
    placed = (
        main.join(F.broadcast(listed), text_key(named(key)) == F.col(hot_key), "left")
        .withColumn(SALT, F.when(of_row > 1, F.pmod(row_hash(main), of_row)).otherwise(F.lit(0)).cast("bigint"))
        .drop(hot_key, salts)
    )
    _save(placed, table, buckets, key, path)


def save_salted_dimension(dim: DataFrame, table: str, main_table: str, buckets: int, *, rowkey: str = "rowkey", path: str | None = None) -> None:
    """``dim``, one row per key, laid out like the salted ``main_table`` of as many buckets: lookups then shuffle neither.

    Rows of the main table's hot keys are copied to each of their salts, together at most ``32 * buckets`` copies more
    and one per hot key. Rows without a key are left out, as nothing finds them. Write it anew with the main table.
    """
    if SALT in dim.columns:
        raise ValueError(f"{SALT} is a column of the rows")
    hot = dim.sparkSession.table(f"{main_table}_hot")
    _save(salt_copies(dim.where(has_key(named(rowkey))), rowkey, hot, SALT), table, buckets, rowkey, path)


def lookup_salted(spark: SparkSession, table: str, dim: DataFrame, key: str, fields: Sequence[Field], *, rowkey: str = "rowkey", **options) -> DataFrame:
    """:func:`~keyloom.operators.lookup.lookup_enrich` of the salted table ``table``, which is not shuffled.

    ``dim`` is any dimension, of which hot keys' rows are copied to their salts, or a table of
    :func:`save_salted_dimension`, known by its salt, which is not shuffled either. ``key`` must be the string column the
    table was salted by. The options are ``require``, ``order_by_version`` (of a plain dimension), ``broadcast_limit`` and ``unknown_share``.
    """
    main = spark.table(table)
    salt = StoredSalt(SALT, spark.table(f"{table}_hot"), SALT if SALT in dim.columns else None)
    return lookup_enrich(main, dim, key, fields, rowkey=rowkey, stored_salt=salt, **options)


def _salts(share: float, buckets: int) -> int:
    return max(1, ceil(_SALTS * buckets * share))


def _writer(df: DataFrame, path: str | None):
    writer = df.write.format("parquet").mode("errorifexists")
    return writer if path is None else writer.option("path", path)


def _save(rows: DataFrame, table: str, buckets: int, key: str, path: str | None) -> None:
    placed = rows.repartition(buckets, named(key), F.col(SALT))
    _writer(placed, path).bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(table)
