"""Compacted cell tables: one version of each cell, laid out so that reading the latest ones takes no work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.operators.cells import CELL_KEY, latest_cells
from keyloom.operators.mutate import upsert_cells
from keyloom.plans.sizing import BROADCAST_LIMIT
from keyloom.plans.skew import LEAST_SHARE, key_shares

# What a compacted table is bucketed by: whole rows together, or the cells of a row apart.
BY_ROW, BY_CELL = "row", "cell"


def compact_cells(
    cells: DataFrame, table: str, buckets: int, *, order_by: Sequence[str] = ("ts",), is_latest: bool = False, by: str | None = None, path: str | None = None
) -> str:
    """The latest version of each cell as a table, bucketed and sorted by cell key, a file to a bucket; returns what it is bucketed by.

    By ``"row"`` the cells of a row key are together: making columns of them, and a lookup join with those, take no
    shuffle. By ``"cell"`` they are spread, for tables where one row key holds so many cells that it would
    fill half a bucket. If ``by`` is not given, a job on the row keys decides. Versions
    are reduced before they are placed, so that a cell with very many of them is no
    hot bucket; with ``is_latest`` the caller vouches that there is one each. An existing table is an error.
    """
    if buckets < 1:
        raise ValueError(f"buckets must be at least 1, got {buckets}")
    if by not in (None, BY_ROW, BY_CELL):
        raise ValueError(f"by is {BY_ROW} or {BY_CELL}, got {by}")
    latest = cells if is_latest else latest_cells(cells, order_by)
    if by is None:
        # Counted are versions, not cells: a row with many versions of few cells is spread needlessly at worst.
        hot = key_shares(cells, "rowkey", min(1.0, max(LEAST_SHARE, 1 / (2 * buckets)))).hot_keys if buckets > 1 else []
        by = BY_CELL if hot else BY_ROW
    keys = ["rowkey"] if by == BY_ROW else CELL_KEY
    writer = latest.repartition(buckets, *keys).write.format("parquet").mode("errorifexists").bucketBy(buckets, *keys).sortBy(*CELL_KEY)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return by


def compacted_cells(
    spark: SparkSession, table: str, delta: DataFrame | None = None, *, order_by: Sequence[str] = ("ts",), broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """The latest cells of a compacted table, with a ``delta`` of further versions merged as they are read.

    Without a delta this is a plain scan, without aggregate, shuffle or sort. A delta is merged by the rules of
    :func:`~keyloom.operators.mutate.upsert_cells`: cells not in it stay, older versions and null values change
    nothing, and at equal versions it wins. While it fits ``broadcast_limit``, measured, the table is not shuffled; once it does
    not, or reads get slow, compact the merged cells into a new table with ``is_latest=True``.
    """
    base = spark.table(table)
    if delta is None:
        return base
    return upsert_cells(base, delta, order_by=order_by, base_is_latest=True, broadcast_limit=broadcast_limit)


def versions_left(spark: SparkSession, table: str) -> DataFrame:
    """Cells that a compacted table holds more than once, none unless something was appended to it: cell key and ``n_versions``."""
    return spark.table(table).groupBy(*CELL_KEY).agg(F.count("*").alias("n_versions")).where("n_versions > 1")
