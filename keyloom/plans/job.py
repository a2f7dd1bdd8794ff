"""The enrichment job: scan, lookup, filter, append."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from keyloom.operators.lookup import Field, lookup_enrich
from keyloom.plans.keyfilter import UNKNOWN_SHARE
from keyloom.plans.settings import apply_settings
from keyloom.plans.sizing import BROADCAST_LIMIT
from keyloom.plans.skew import HOT_SHARE
from keyloom.sinks.tables import append
from keyloom.sources.tables import as_frame, project_main, register_dimension


def run_enrichment(
    spark: SparkSession,
    main: str | DataFrame,
    dim: str | DataFrame,
    key: str,
    fields: Sequence[Field],
    *,
    sink: str,
    columns: Sequence[Field] | None = None,
    rowkey: str = "rowkey",
    require: Sequence[str] = (),
    order_by_version: str | None = None,
    partitions: int | None = None,
    by_name: bool = False,
    broadcast_limit: int | None = BROADCAST_LIMIT,
    hot_share: float | None = HOT_SHARE,
    unknown_share: float | None = UNKNOWN_SHARE,
    run_id: str | None = None,
) -> None:
    """Append ``main`` enriched from ``dim`` to the table ``sink``.

    ``columns`` are the main columns to keep, all by default. Unlike the lazy
    :func:`lookup_enrich`, the job measures first: a dimension within
    ``broadcast_limit`` is broadcast and main is not shuffled; beyond it, keyless, hot and, from ``unknown_share`` on,
    unknown keys are kept out of the shuffled join. With a ``run_id`` a second run replaces the first (:func:`~keyloom.sinks.tables.append`).
    """
    main, dim = as_frame(spark, main), as_frame(spark, dim)
    if columns is not None:
        main = project_main(main, columns, key)
    enriched = lookup_enrich(
        main,
        dim,
        key,
        fields,
        rowkey=rowkey,
        require=require,
        order_by_version=order_by_version,
        partitions=partitions,
        broadcast_limit=broadcast_limit,
        split_null_keys=True,
        hot_share=hot_share,
        unknown_share=unknown_share,
    )
    append(enriched, sink, by_name=by_name, run_id=run_id)


def run_sql_enrichment(spark: SparkSession, text: str, *, sink: str, by_name: bool = False) -> None:
    """Append the result of SQL text over catalog tables and registered dimensions to ``sink``."""
    append(spark.sql(text), sink, by_name=by_name)


def _dimension(spark: SparkSession, given: str) -> None:
    """Registers ``table:view:rowkey[:version[:field,field...]]``."""
    parts = given.split(":")
    if len(parts) not in (3, 4, 5):
        raise ValueError(f"--dimension wants table:view:rowkey[:version[:field,field...]], got {given}")
    fields = parts[4].split(",") if len(parts) == 5 else None
    register_dimension(spark.table(parts[0]), parts[1], rowkey=parts[2], order_by_version=parts[3] if len(parts) > 3 and parts[3] else None, fields=fields)


def _field(given: str) -> Field:
    name, _, alias = given.partition(":")
    return (name, alias) if alias else name


def main(argv: Sequence[str] | None = None) -> None:
    """``spark-submit`` entry: SQL text over registered dimensions, or one measured lookup, appended to a table."""
    parser = argparse.ArgumentParser(description="Append the result of an enrichment to a table.")
    parser.add_argument("--sink", required=True, help="existing table to append to")
    parser.add_argument("--by-name", action="store_true", help="match sink columns by name, not position")
    parser.add_argument("--dimension", action="append", default=[], metavar="TABLE:VIEW:ROWKEY[:VERSION[:FIELD,FIELD]]", help="view for --sql, or the one dimension of --main; repeatable. Name the fields of a versioned one: others are then neither read nor compared")
    parser.add_argument("--sql", help="SELECT main and dimension columns FROM main LEFT JOIN view")
    parser.add_argument("--main", help="main table of a lookup without SQL")
    parser.add_argument("--key", help="its lookup key")
    parser.add_argument("--fields", nargs="+", default=[], metavar="FIELD[:ALIAS]", help="dimension columns to append")
    parser.add_argument("--columns", nargs="+", metavar="COLUMN[:ALIAS]", help="main columns to keep; all by default")
    parser.add_argument("--require", nargs="+", default=[], help="aliases that must not be null")
    parser.add_argument("--run-id", help="of a --main run; a second run of it replaces the first in a sink partitioned by run_id")
    parser.add_argument("--partitions", type=int, help="partitions of the rows placed by key")
    args = parser.parse_args(argv)
    if bool(args.sql) == bool(args.main):
        parser.error("give either --sql or --main")
    if args.main and (not args.key or len(args.dimension) != 1):
        parser.error("--main needs --key and one --dimension")
    spark = SparkSession.builder.appName("keyloom enrichment").getOrCreate()
    apply_settings(spark)
    if args.sql:
        for given in args.dimension:
            _dimension(spark, given)
        run_sql_enrichment(spark, args.sql, sink=args.sink, by_name=args.by_name)
        return
    table, _, rowkey, *version = args.dimension[0].split(":")
    run_enrichment(
        spark,
        args.main,
        table,
        args.key,
        list(map(_field, args.fields)),
        sink=args.sink,
        columns=None if args.columns is None else list(map(_field, args.columns)),
        rowkey=rowkey,
        require=args.require,
        order_by_version=version[0] or None if version else None,
        partitions=args.partitions,
        by_name=args.by_name,
        run_id=args.run_id,
    )


if __name__ == "__main__":
    main()
