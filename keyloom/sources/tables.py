"""Main tables and dimensions as inputs of an enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from keyloom.functions.keys import free_name, has_key, named
from keyloom.operators.lookup import Field, latest_rows, lookup_enrich


def as_frame(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A table name or a DataFrame, as a DataFrame."""
    return spark.table(table) if isinstance(table, str) else table


def project_main(main: DataFrame, columns: Sequence[Field], key: str | None = None) -> DataFrame:
    """The wanted main columns, ``column`` or ``(column, alias)``, plus the lookup key if named.

    Only these columns are read from the source.
    """
    pairs = [(c, c) if isinstance(c, str) else (c[0], c[1]) for c in columns]
    if key is not None:
        if any(a == key != c for c, a in pairs):
            raise ValueError(f"a column is named like the lookup key: {key}")
        if key not in [alias for _, alias in pairs]:
            pairs.append((key, key))
    return main.select(*[named(c).alias(a) for c, a in pairs])


def register_dimension(
    dim: DataFrame,
    view: str,
    *,
    rowkey: str = "rowkey",
    fields: Sequence[str] | None = None,
    order_by_version: str | None = None,
) -> None:
    """Make ``dim`` a view that SQL text can left join on ``rowkey`` with lookup semantics.

    Rows without a key are not in the view, so an empty key in the main table
    finds nothing, and with ``order_by_version`` each key has one row, so the
    join multiplies no main row. Filters, projections and functions in the text
    are Spark SQL; the optimizer pushes them through the view to the scans.

    Name the ``fields`` the text may use when versions are reduced: whole rows
    are compared there, so other columns would be read even if unused.
    """
    dim = dim.where(has_key(named(rowkey)))
    if fields is not None:
        dim = dim.select(*map(named, dict.fromkeys([rowkey, *fields, *([order_by_version] if order_by_version else [])])))
    if order_by_version is not None:
        dim = latest_rows(dim, rowkey, order_by_version)
    dim.createOrReplaceTempView(view)


def register_lookup(main: DataFrame, dim: DataFrame, view: str, key: str, fields: Sequence[Field], **options) -> None:
    """Make ``main`` with looked-up ``fields`` of ``dim`` one view, which SQL text reads without a join of its own.

    The view holds the join of :func:`~keyloom.operators.lookup.lookup_enrich`, measured, salted or split by its ``options``;
    so hot and keyless rows and versions are taken care of whatever the text does.
    ``key`` stays a column of the view.
    """
    kept = main.select("*", named(key).alias(_held(main)))
    lookup_enrich(kept, dim, _held(main), fields, **options).createOrReplaceTempView(view)


def _held(main: DataFrame) -> str:
    return free_name(main.columns, "__lookup_key")
