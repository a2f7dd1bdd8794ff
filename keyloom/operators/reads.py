"""Reads of keyed tables: by key, by many keys, by key range."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.keys import free_name, named, text_key
from keyloom.operators.cells import CELL_KEY, DEFAULT_FAMILY, latest_cells
from keyloom.operators.keyjoin import join_by_key
from keyloom.plans.sizing import fits_in_broadcast

# Fixed value: appended to the end key of a range, which is then exclusive.
RANGE_END_SUFFIX = "0"


def get_row(table: DataFrame, key: str, rowkey: str = "rowkey") -> DataFrame:
    """The row (or all cells) of one key. The equality reaches the scan."""
    return table.where(named(rowkey) == key)


def get_rows(table: DataFrame, keys: Sequence[str], rowkey: str = "rowkey") -> DataFrame:
    """The rows of a few keys, as literals that reach the scan: row groups whose order or Bloom filters exclude all of them are skipped.

    Spark passes equalities of at most ten values on as such, so the keys go in tens.
    """
    wanted = sorted({k for k in keys if k is not None})
    tens = [named(rowkey).isin(wanted[i : i + 10]) for i in range(0, len(wanted), 10)]
    return table.where(reduce(or_, tens, F.lit(False)))


def requested(spark: SparkSession, keys: Sequence[str | None]) -> DataFrame:
    """Requests ``(pos, rowkey)`` for a list of keys typed in by hand, in list order."""
    listed = F.array(*[F.lit(k).cast("string") for k in keys]).cast("array<string>")
    return spark.range(1).select(F.posexplode(listed).alias("pos", "rowkey"))


def multi_get(
    requests: DataFrame,
    table: DataFrame,
    *,
    key: str = "rowkey",
    rowkey: str = "rowkey",
    hot_share: float | None = None,
    split_null_keys: bool = False,
    broadcast_limit: int | None = None,
    unknown_share: float | None = None,
    few_keys: int | None = None,
) -> DataFrame:
    """Every request row with the table row of its key: duplicates kept, nulls where there is no row.

    Carry a position column in ``requests`` and sort by it where the order
    matters; a sort of all answers is not forced here. Where the requests have at most
    ``few_keys`` different keys, and these are strings, the table is read by them (:func:`get_rows`); a job looks for that
    many keys. Other options as in :func:`~keyloom.operators.keyjoin.join_by_key`.
    """
    columns = [c for c in table.columns if c != rowkey]
    clash = set(columns) & set(requests.columns)
    if clash:
        raise ValueError(f"columns of both requests and table: {sorted(clash)}")
    if few_keys and table.schema[rowkey].dataType.typeName() == requests.schema[key].dataType.typeName() == "string":
        asked = requests.select(named(key).alias("key")).where("key is not null").distinct().limit(few_keys + 1).collect()
        if len(asked) <= few_keys:
            table = get_rows(table, [r["key"] for r in asked], rowkey)
    row = free_name([*requests.columns, *columns], "__rowkey")
    right = table.select(named(rowkey).alias(row), *map(named, columns))
    return join_by_key(
        requests,
        key,
        right,
        row,
        hot_share=hot_share,
        split_null_keys=split_null_keys,
        broadcast_limit=broadcast_limit,
        unknown_share=unknown_share,
    ).select(*map(named, [*requests.columns, *columns]))


def _distinct_keys(keys: DataFrame, key: str) -> DataFrame:
    """A key asked for very often then meets the join once, and the join reuses this shuffle."""
    return keys.select(named(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()


def get_cells(
    table: DataFrame,
    keys: DataFrame,
    fields: Sequence[str],
    *,
    rowkey: str = "rowkey",
    key: str = "rowkey",
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Chosen columns of the rows with the given keys, one row per present value."""
    rows = table.select(named(rowkey).alias("rowkey"), *[named(f).cast("string").alias(f) for f in fields])
    wanted = _distinct_keys(keys, key)
    return (
        join_by_key(rows, "rowkey", wanted, "__key", "left_semi", broadcast_limit=broadcast_limit)
        .unpivot("rowkey", list(map(named, fields)), "qualifier", "value")
        .where("value is not null")
    )


def get_latest_cells(
    cells: DataFrame,
    keys: DataFrame,
    fields: Sequence[str],
    *,
    family: str = DEFAULT_FAMILY,
    key: str = "rowkey",
    order_by: Sequence[str] = ("ts",),
    broadcast_limit: int | None = None,
) -> DataFrame:
    """:func:`get_cells` of a cell table: the latest version of the chosen columns of one family.

    Keys measured small filter the cells first. Otherwise each row is reduced to the
    latest version per chosen column before it meets the keys, and the join reuses
    that one shuffle; a row with very many versions does not weigh on it.
    """
    chosen = cells.where((F.col("family") == family) & F.col("qualifier").isin(list(fields)))
    wanted = _distinct_keys(keys, key)
    if broadcast_limit is not None and fits_in_broadcast(wanted, broadcast_limit):
        on = F.col("rowkey") == F.col("__key")
        return latest_cells(chosen.join(F.broadcast(wanted), on, "left_semi"), order_by)
    names = list(dict.fromkeys(fields))
    if not names:
        return chosen
    rest = [c for c in cells.columns if c not in (*CELL_KEY, *order_by)]
    version = F.struct(*map(named, [*order_by, *rest]))
    rows = chosen.groupBy("rowkey").agg(*[F.max(F.when(F.col("qualifier") == q, version)).alias(f"__{i}") for i, q in enumerate(names)])
    found = join_by_key(rows, "rowkey", wanted, "__key", "left_semi")
    listed = F.array(*[F.struct(F.lit(q).alias("qualifier"), F.col(f"__{i}").alias("cell")) for i, q in enumerate(names)])
    one = found.select("rowkey", F.inline(listed)).where("cell is not null")
    fixed = {"rowkey": F.col("rowkey"), "family": F.lit(family).alias("family"), "qualifier": F.col("qualifier")}
    return one.select(*[fixed[c] if c in fixed else F.col("cell")[c].alias(c) for c in cells.columns])


def range_scan(table: DataFrame, begin: str, end: str, rowkey: str = "rowkey") -> DataFrame:
    """Rows with ``begin <= key < end + '0'`` in byte order: ``end`` itself is included.

    Both bounds are literals, so they reach the scan; on a table sorted by key
    (see :func:`keyloom.sinks.keyed.write_keyed`) most files and row groups are skipped.
    Keys of another type are compared as text, as in lookups.
    """
    column = named(rowkey)
    if table.schema[rowkey].dataType.typeName() != "string":
        column = text_key(column)
    return table.where((column >= begin) & (column < end + RANGE_END_SUFFIX))


def range_scan_family(cells: DataFrame, family: str, begin: str, end: str) -> DataFrame:
    """:func:`range_scan` of a cell table, one column family only."""
    return range_scan(cells.where(F.col("family") == family), begin, end)
