"""Upserts and deletes on keyed tables, as jobs that compute the new table.

Write the result to a new path or table (see :mod:`keyloom.sinks`); none of
these changes its input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import free_name, named
from keyloom.operators.cells import CELL_KEY
from keyloom.operators.keyjoin import join_by_key
from keyloom.plans.sizing import fits_in_broadcast


def _versions(side: DataFrame, put: int, order_by: Sequence[str], columns: Sequence[str], types: dict) -> DataFrame:
    """Cell key and one struct that sorts by version, then put before base, then value."""
    missing = {c: F.lit(None).cast(types[c]).alias(c) for c in order_by if c not in side.columns}
    rest = [c for c in columns if c not in CELL_KEY and c not in order_by]
    order = [missing.get(c, named(c)) for c in order_by]
    return side.select(*CELL_KEY, F.struct(*order, F.lit(put).alias("__put"), *map(named, rest)).alias("__cell"))


def _newest(versions: DataFrame) -> DataFrame:
    return versions.groupBy(*CELL_KEY).agg(F.max("__cell").alias("__cell"))


def upsert_cells(
    base: DataFrame,
    puts: DataFrame,
    *,
    order_by: Sequence[str] = ("ts",),
    base_is_latest: bool = False,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The latest cells of ``base`` after ``puts``, with the columns of ``base``.

    Cells not put stay, and a null value puts nothing. At equal versions a put
    wins over the base. Version columns that only ``puts`` has (a sequence
    number, say) count as lowest in the base.

    * A base with many versions per cell is reduced together with the puts.
    * When it already holds one version per cell (``base_is_latest``) there is
      nothing to reduce: only the puts are, and each base row meets the newest put
      of its cell. Should the base hold several rows of a cell after all, each stays.
    * When, besides, the measured puts fit ``broadcast_limit``, they go to the base,
      which is not shuffled; it is read a second time for its cell keys only.

    Null families and qualifiers are values like others. The size of the puts decides
    the plan, never the answer.
    """
    puts = puts.where(F.col("value").isNotNull())
    common = [c for c in puts.columns if c in base.columns]
    puts = puts.withColumns({c: named(c).cast(base.schema[c].dataType) for c in common})
    types = {**dict(puts.dtypes), **dict(base.dtypes)}
    old = _versions(base, 0, order_by, base.columns, types)
    new = _versions(puts, 1, order_by, base.columns, types)

    if not base_is_latest:
        merged = _newest(old.unionByName(new))
    else:
        newest = _newest(new).select(*[F.col(c).alias(f"__{c}") for c in CELL_KEY], F.col("__cell").alias("__new"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in CELL_KEY])
        small = broadcast_limit is not None and fits_in_broadcast(puts, broadcast_limit)
        both = old.join(F.broadcast(newest), same, "left") if small else old.join(newest, same, "full")
        keys = [F.coalesce(c, f"__{c}").alias(c) for c in CELL_KEY]
        merged = both.select(*keys, F.greatest("__cell", "__new").alias("__cell"))
        if small:
            # No more cells than puts, which were measured: safe to broadcast in turn.
            met = base.select(*CELL_KEY).join(F.broadcast(newest), same, "left_semi").distinct()
            added = newest.join(F.broadcast(met), same, "left_anti")
            merged = merged.unionByName(added.select(*[F.col(f"__{c}").alias(c) for c in CELL_KEY], F.col("__new").alias("__cell")))
    return merged.select(*[c if c in CELL_KEY else F.col("__cell")[c].alias(c) for c in base.columns])


def put_cell(base: DataFrame, rowkey: str, family: str, qualifier: str, value: str, ts) -> DataFrame:
    """Upsert of a single cell, with version ``ts``; all other cells pass through in place, as they are."""
    put = base.sparkSession.range(1).select(
        F.lit(rowkey).alias("rowkey"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        F.lit(ts).cast(base.schema["ts"].dataType).alias("ts"),
        F.lit(value).alias("value"),
    )
    cell = (
        F.col("rowkey").eqNullSafe(rowkey)
        & F.col("family").eqNullSafe(family)
        & F.col("qualifier").eqNullSafe(qualifier)
    )
    return base.where(~cell).unionByName(upsert_cells(base.where(cell), put))


def upsert_column(
    base: DataFrame,
    puts: DataFrame,
    column: str,
    *,
    rowkey: str = "rowkey",
    order_by: Sequence[str] = (),
    broadcast_limit: int | None = None,
) -> DataFrame:
    """``base`` (one row per key) with ``column`` set from ``puts(rowkey, column)``.

    Keys new to the base become rows whose other columns are null. Several puts
    for a key are settled by ``order_by``, then by the greatest value. A null
    value puts nothing.

    When the measured puts fit ``broadcast_limit`` the base is not shuffled:
    the puts go to the base rows, and the new keys are the puts that met none.
    """
    puts = puts.where(named(column).isNotNull())
    key, value = free_name(base.columns, "__key"), free_name(base.columns, "__new")
    new = (
        puts.groupBy(named(rowkey).alias(key))
        .agg(F.max(F.struct(*map(named, order_by), named(column).alias(value)))[value].alias(value))
        .select(key, value)
    )
    same = named(rowkey) == F.col(key)
    changed = F.coalesce(F.col(value), named(column)).alias(column)
    columns = [changed if c == column else F.coalesce(named(c), F.col(key)).alias(c) if c == rowkey else named(c) for c in base.columns]
    # Measured before the puts are reduced to one per key: no shuffle, and an upper bound.
    if broadcast_limit is None or not fits_in_broadcast(puts.select(named(rowkey), named(column)), broadcast_limit):
        return base.join(new, same, "full").select(*columns)

    new = F.broadcast(new)
    updated = base.join(new, same, "left").select(*columns)
    # No more keys than puts, which were measured: safe to broadcast in turn.
    found = F.broadcast(base.select(named(rowkey)).join(new.select(key), same, "left_semi").distinct())
    inserted = new.join(found, same, "left_anti").select(
        *[
            F.col(key).alias(c) if c == rowkey else F.col(value).alias(c) if c == column else F.lit(None).cast(t).alias(c)
            for c, t in base.dtypes
        ]
    )
    return updated.unionByName(inserted)


def _fits(puts: DataFrame, columns: str, values: str):
    return F.coalesce(F.size(columns) == F.size(values), F.lit(False))


def array_puts(puts: DataFrame, family: str, *, columns: str = "columns", values: str = "values") -> DataFrame:
    """Cells of put rows ``(rowkey, columns array, values array, ts)``, with their array position ``seq``.

    Rows whose arrays differ in length are refused whole (:func:`rejected_puts`).
    """
    return (
        puts.where(_fits(puts, columns, values))
        .select(
            "rowkey",
            F.lit(family).alias("family"),
            "ts",
            F.posexplode(F.arrays_zip(F.col(columns).alias("q"), F.col(values).alias("v"))).alias("seq", "pair"),
        )
        .select("rowkey", "family", F.col("pair.q").alias("qualifier"), "ts", F.col("pair.v").alias("value"), "seq")
    )


def rejected_puts(puts: DataFrame, *, columns: str = "columns", values: str = "values") -> DataFrame:
    """Put rows that :func:`upsert_arrays` refuses."""
    return puts.where(~_fits(puts, columns, values))


def upsert_arrays(
    base: DataFrame,
    puts: DataFrame,
    family: str,
    *,
    columns: str = "columns",
    values: str = "values",
    base_is_latest: bool = False,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Upsert several columns per row, given as parallel arrays; a column named twice takes its last value."""
    return upsert_cells(
        base,
        array_puts(puts, family, columns=columns, values=values),
        order_by=("ts", "seq"),
        base_is_latest=base_is_latest,
        broadcast_limit=broadcast_limit,
    )


def delete_rows(
    base: DataFrame,
    keys: DataFrame,
    *,
    rowkey: str = "rowkey",
    key: str = "rowkey",
    broadcast_limit: int | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """``base`` without the listed keys; of a cell table, every family, column and version goes.

    Keys are made distinct before the join, so a key listed very often is one
    row there. Options as in :func:`~keyloom.operators.keyjoin.join_by_key`;
    ``hot_share`` is for cell tables, where one row may hold very many cells.
    """
    gone_key = free_name(base.columns, "__key")
    gone = keys.select(named(key).alias(gone_key)).where(F.col(gone_key).isNotNull()).distinct()
    return join_by_key(
        base, rowkey, gone, gone_key, "left_anti", broadcast_limit=broadcast_limit, hot_share=hot_share
    )


def delete_row(base: DataFrame, key: str, *, rowkey: str = "rowkey") -> DataFrame:
    """``base`` without one key: a filter, no join."""
    return base.where(~named(rowkey).eqNullSafe(key))
