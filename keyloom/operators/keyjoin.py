"""The skew-safe join on a lookup key that lookups, multi-gets and deletes share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import free_name, has_key, named, text_key
from keyloom.operators.partition import repartition_by_key, split_by_key, spreading_salt
from keyloom.plans.keyfilter import FULL_SHARE, key_filter
from keyloom.plans.sizing import BROADCAST_LIMIT, fits_in_broadcast
from keyloom.plans.skew import HOT_SHARE, key_shares

# Share of keyless and hot rows from which a second read of the left side costs less than shuffling them.
SPLIT_SHARE = 0.3
# Salts to a partition: a hot key's rows are then spread about evenly, though salts are hashed.
_SALTS = 8


def _salted(left: DataFrame, key: str, right: DataFrame, rowkey: str, on, how: str, hot_keys: Sequence[str], partitions: int | None) -> DataFrame:
    """The join in one read of ``left``: its keyless and hot rows are spread by a salt, and the right rows of hot keys copied to each salt."""
    salts = _SALTS * (partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = [*left.columns, *right.columns]
    salt, right_salt = free_name(names, "__salt"), free_name(names, "__right_salt")
    left = left.withColumn(salt, F.pmod(spreading_salt(left, key, hot_keys), F.lit(salts)))
    if partitions:
        left = left.repartition(partitions, named(key), F.col(salt))
    copies = F.array(F.lit(0).cast("bigint"))
    if hot_keys:
        hot = text_key(named(rowkey)).isin(list(hot_keys))
        copies = F.when(hot, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(copies)
    right = right.withColumn(right_salt, F.explode(copies))
    return left.join(right, on & (F.col(salt) == F.col(right_salt)), how).drop(salt, right_salt)


@dataclass(frozen=True)
class StoredSalt:
    """The salt that the left side was bucketed with besides its key.

    ``column`` holds it, ``hot`` lists the hot keys (``hot_key``, at most 10,000) and how many ``salts`` each
    has, and ``right`` is the right side's salt, if its rows were copied to their salts already.
    """

    column: str
    hot: DataFrame
    right: str | None = None


def salt_copies(right: DataFrame, rowkey: str, hot: DataFrame, column: str) -> DataFrame:
    """``right`` with each row once for every salt of its key, in ``column``; rows of keys that are not hot have salt 0."""
    key, salts = free_name(right.columns, "__hot_key"), free_name(right.columns, "__salts")
    listed = F.broadcast(hot.select(F.col("hot_key").alias(key), F.col("salts").alias(salts)))
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(salts), F.lit(1)) - 1)
    return right.join(listed, text_key(named(rowkey)) == F.col(key), "left").withColumn(column, F.explode(every)).drop(key, salts)


def _join_stored(left: DataFrame, right: DataFrame, rowkey: str, on, how: str, salt: StoredSalt) -> DataFrame:
    """The join by key and stored salt, for which a ``left`` bucketed by both is not shuffled."""
    right_salt = salt.right
    if right_salt is None:
        right_salt = free_name([*left.columns, *right.columns], "__right_salt")
        right = salt_copies(right, rowkey, salt.hot, right_salt)
    return left.join(right, on & (named(salt.column) == named(right_salt)), how)


def _without_match(free: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Left rows that match nothing, as the join gives them back."""
    if how == "left":
        return free.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return free


def join_by_key(
    left: DataFrame,
    key: str,
    right: DataFrame,
    rowkey: str,
    how: str = "left",
    *,
    hot_keys: Sequence[str] = (),
    hot_share: float | None = None,
    split_null_keys: bool = False,
    partitions: int | None = None,
    broadcast_limit: int | None = None,
    measured: DataFrame | None = None,
    unknown_share: float | None = None,
    stored_salt: StoredSalt | None = None,
) -> DataFrame:
    """Join ``left`` with the one ``right`` row per key; ``how`` is left, left_semi or left_anti.

    The two share no column name. Null and empty keys match nothing; keys of
    different types are compared as text. How the options shape the plan:

    * ``broadcast_limit``: measure ``right`` and broadcast it when it fits.
      ``left`` is then read once and not shuffled; skew no longer matters. Stored files that are
      far larger are not measured. ``measured`` stands for ``right`` in measuring: rows with the same columns that
      are no fewer and cheaper to make, such as all versions of the rows.
    * ``unknown_share``: a bitmap of the right keys, of 16 MB at most, tells which left rows surely match
      nothing. Where they are at least that share of all, they do not go through the
      join and its shuffle.
    * ``split_null_keys``: rows without a key skip the join and its shuffle;
      together with ``hot_share``, where they are at least that share.
    * ``hot_keys`` / ``hot_share``: rows of the hot keys (given, or found at that
      share) are joined in place with a measured broadcast of just their rows.
    * ``partitions``: the rows are placed in that many partitions, the keyless and
      hot ones spread over them; hot keys are looked for if none are given. Spark raises a number below ``spark.sql.shuffle.partitions``
      to that.
    * ``stored_salt``: ``left`` is bucketed by key and salt and is not shuffled; hot keys are spread as stored.
    * none of these: one plain join; Spark's size statistics and adaptive skew
      handling decide.

    Measuring and finding run a job each when the join is built, on ``right``
    and on the key column of ``left``. Where the found hot and keyless rows are under
    ``SPLIT_SHARE`` of all, or ``partitions`` is given, they are shuffled with a salt
    and ``left`` is read once. The other split plans read it twice, so checkpoint it
    when it is costly or not repeatable.
    """
    # A row key is never empty, so an empty key finds nothing. Comparing the
    # bare columns keeps any bucketing or partitioning of either side usable.
    whole, right = right, right.where(has_key(named(rowkey)))
    on = named(key) == named(rowkey)
    if left.schema[key].dataType != right.schema[rowkey].dataType:
        on = text_key(named(key)) == text_key(named(rowkey))
    if broadcast_limit is not None and fits_in_broadcast(whole if measured is None else measured, broadcast_limit):
        if partitions:
            left = repartition_by_key(left, key, partitions, hot_keys)
        if stored_salt and stored_salt.right:
            right = right.where(named(stored_salt.right) == 0)  # of the copies one each
        return _unsalted(left.join(F.broadcast(right), on, how), left, right, how, stored_salt)
    unknown = None
    if unknown_share is not None:
        known = key_filter(whole if measured is None else measured, rowkey)
        if known.filled < FULL_SHARE and known.unknown_share(left, key) >= unknown_share:
            mark = free_name([*left.columns, *right.columns], "__known")
            marked = known.mark(left, key, mark)
            unknown = _without_match(marked.where(~F.col(mark)).drop(mark), right, how)
            left, split_null_keys = marked.where(F.col(mark)).drop(mark), False
    if stored_salt is not None:
        joined = _unsalted(_join_stored(left, right, rowkey, on, how, stored_salt), left, right, how, stored_salt)
        unknown = None if unknown is None else _unsalted(unknown, left, right, how, stored_salt)
    else:
        joined = _join(left, key, right, rowkey, on, how, hot_keys, hot_share, split_null_keys, partitions, broadcast_limit)
    return joined if unknown is None or how == "left_semi" else joined.unionByName(unknown)


def _unsalted(joined: DataFrame, left: DataFrame, right: DataFrame, how: str, salt: StoredSalt | None) -> DataFrame:
    """The columns of the two sides without their salts."""
    if salt is None:
        return joined
    kept = [c for c in left.columns if c != salt.column]
    if how == "left":
        kept += [c for c in right.columns if c != salt.right]
    return joined.select(*map(named, kept))


def _join(left, key, right, rowkey, on, how, hot_keys, hot_share, split_null_keys, partitions, broadcast_limit) -> DataFrame:
    free_share = 1.0
    if partitions and hot_share is None and not hot_keys:
        hot_share = HOT_SHARE
    if hot_share is not None:
        shares = key_shares(left, key, hot_share)
        hot_keys = sorted({*hot_keys, *shares.hot_keys})
        split_null_keys = split_null_keys and shares.keyless >= hot_share
        free_share = shares.hot + shares.keyless
    if not (hot_keys or split_null_keys or partitions):
        return left.join(right, on, how)

    if partitions or free_share < SPLIT_SHARE:
        return _salted(left, key, right, rowkey, on, how, hot_keys, partitions)
    cold, free = split_by_key(left, key, hot_keys)
    joined = cold.join(right, on, how)
    if hot_keys:
        hot_rows = right.where(text_key(named(rowkey)).isin(list(hot_keys)))
        limit = BROADCAST_LIMIT if broadcast_limit is None else broadcast_limit
        if fits_in_broadcast(hot_rows, limit):
            hot_rows = F.broadcast(hot_rows)
        return joined.unionByName(free.join(hot_rows, on, how))
    return joined if how == "left_semi" else joined.unionByName(_without_match(free, right, how))
