"""Cell tables: one row per version of a cell.

A cell table has the columns ``rowkey, family, qualifier, ts, value``, all
strings but the version ``ts``. An absent value has no row; an empty one has
``''``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.codec import decode_text
from keyloom.functions.keys import free_name, named

# Fixed value: the one column family that lookups read.
DEFAULT_FAMILY = "f1"

CELL_KEY = ["rowkey", "family", "qualifier"]
CELL_SCHEMA = "rowkey STRING, family STRING, qualifier STRING, ts TIMESTAMP_NTZ, value STRING"


def empty_cells(spark: SparkSession) -> DataFrame:
    """A cell table without cells, to create a table from."""
    return spark.createDataFrame([], CELL_SCHEMA)


def latest_cells(cells: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """The latest version of every cell.

    ``order_by`` lists the version columns, most significant first; ties after
    those go to the greatest value, so a rerun gives the same answer. Versions
    are reduced on the map side before they are shuffled, so neither a row nor
    a cell with a large share of all versions overloads a task.
    """
    rest = [c for c in cells.columns if c not in (*CELL_KEY, *order_by)]
    cell = free_name(cells.columns, "__cell")
    return (
        cells.groupBy(*CELL_KEY)
        .agg(F.max(F.struct(*map(named, [*order_by, *rest]))).alias(cell))
        .select(*[c if c in CELL_KEY else F.col(cell)[c].alias(c) for c in cells.columns])
    )


def decode_cells(cells: DataFrame) -> DataFrame:
    """A cell table whose texts are held as UTF-8 bytes, with its binary columns as strings."""
    return cells.select(*[decode_text(named(c)).alias(c) if t == "binary" else named(c) for c, t in cells.dtypes])


def cells_to_wide(
    cells: DataFrame,
    qualifiers: Sequence[str],
    family: str | None = DEFAULT_FAMILY,
    order_by: Sequence[str] = ("ts",),
) -> DataFrame:
    """One row per key with the latest value of each wanted qualifier, null where absent.

    One aggregate and one shuffle whatever the number of qualifiers. Keys with
    none of them give no row. The result is partitioned by ``rowkey``, which a
    following lookup join reuses.
    """
    wanted = F.col("qualifier").isin(list(qualifiers))
    if family is not None:
        wanted = wanted & (F.col("family") == family)
    version = F.struct(*map(named, order_by), "value")
    return (
        cells.where(wanted)
        .groupBy("rowkey")
        .agg(*[F.max(F.when(F.col("qualifier") == q, version)).alias(q) for q in qualifiers])
        .select("rowkey", *[named(q)["value"].alias(q) for q in qualifiers])
    )


def wide_to_cells(wide: DataFrame, families: Mapping[str, str], *, rowkey: str = "rowkey", ts: str) -> DataFrame:
    """Cells of a wide keyed table: ``families`` gives the family of each column taken over.

    Null values are absent cells and give no row. ``ts`` names the version column.
    """
    family = reduce(
        lambda acc, kv: acc.when(F.col("qualifier") == kv[0], kv[1]),
        list(families.items())[1:],
        F.when(F.col("qualifier") == next(iter(families)), families[next(iter(families))]),
    )
    return (
        wide.select(
            named(rowkey).cast("string").alias("rowkey"),
            named(ts).alias("ts"),
            *[named(c).cast("string").alias(c) for c in families],
        )
        .unpivot(["rowkey", "ts"], list(map(named, families)), "qualifier", "value")
        .where("value is not null")
        .select("rowkey", family.alias("family"), "qualifier", "ts", "value")
    )
