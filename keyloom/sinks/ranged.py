"""Keyed tables cut into key ranges, of which a change rewrites only those it touches.

A ranged table is a catalog table partitioned by ``key_range``. Beside it, ``<table>_ranges``
holds the least key of each range when the table was made; a key belongs to the last
range whose least key is not above it, and keys under all of them to the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.keys import named, text_key
from keyloom.operators.mutate import delete_rows, upsert_cells, upsert_column
from keyloom.operators.reads import RANGE_END_SUFFIX, range_scan
from keyloom.plans.sizing import BROADCAST_LIMIT

RANGE = "key_range"
# The bounds are held by the driver and sent with the plans.
MOST_RANGES = 10_000
_GROUP = 100  # bounds are searched in two steps


def save_ranged(df: DataFrame, table: str, ranges: int, *, rowkey: str = "rowkey", path: str | None = None) -> None:
    """``df`` as a table of about ``ranges`` key ranges, one file and one directory each, sorted by key.

    Choose ``ranges`` so that one is what a task can rewrite, a few hundred megabytes. All
    rows of a key are in one range. An existing table is an error.
    """
    if not 1 <= ranges <= MOST_RANGES:
        raise ValueError(f"ranges must be in [1, {MOST_RANGES}], got {ranges}")
    if RANGE in df.columns:
        raise ValueError(f"{RANGE} is a column of the rows")
    placed = df.repartitionByRange(ranges, named(rowkey)).withColumn(RANGE, F.spark_partition_id())
    _writer(placed.sortWithinPartitions(RANGE, named(rowkey)), path).partitionBy(RANGE).saveAsTable(table)
    written = df.sparkSession.table(table)
    bounds = written.groupBy(RANGE).agg(F.min(text_key(named(rowkey))).alias("least"))
    _writer(bounds.coalesce(1), None if path is None else f"{path}_ranges").saveAsTable(f"{table}_ranges")


def _writer(df: DataFrame, path: str | None):
    writer = df.write.format("parquet").mode("errorifexists")
    return writer if path is None else writer.option("path", path)


def _bounds(spark: SparkSession, table: str) -> list[tuple[str | None, int]]:
    """Least key and number of the ranges, in order: ``MOST_RANGES`` rows at most."""
    rows = spark.table(f"{table}_ranges").orderBy(F.col("least").asc_nulls_first()).collect()
    return [(r["least"], r[RANGE]) for r in rows]


def _range_of(key: Column, bounds: list[tuple[str | None, int]]) -> Column:
    """Number of the range that ``key`` belongs to; a null key to the first."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + _GROUP] for i in range(0, len(bounds), _GROUP)]
    text = F.coalesce(text_key(key), F.lit(""))

    def upto(leasts: list[str | None]) -> Column:
        """Bounds that are not above the key, the first one always."""
        if len(leasts) == 1:
            return F.lit(1)
        return 1 + F.size(F.filter(F.array(*[F.lit(least) for least in leasts[1:]]), lambda least: least <= text))

    group = upto([g[0][0] for g in groups])
    numbers = [F.element_at(F.array(*[F.lit(n) for _, n in g]), upto([least for least, _ in g])) for g in groups]
    found = numbers[-1]
    for i in range(len(groups) - 1, 0, -1):  # one branch is evaluated per key
        found = F.when(group == i, numbers[i - 1]).otherwise(found)
    return found.cast("int")


def rewrite_ranges(
    spark: SparkSession, table: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame], *, rowkey: str = "rowkey", key: str = "rowkey"
) -> list[int]:
    """Replace the ranges of ``table`` that ``keys`` fall in by what ``change`` makes of their rows; returns their numbers.

    Other ranges are neither read nor written, and keep their files. ``change`` must give rows of
    those ranges only, as upserts and deletes of ``keys`` do. Ranges left without rows are dropped. New files are moved in
    when all are written, range by range, so a job that dies before leaves the table as it
    was; run the same change again after one that dies while they are moved. One writer at a time.
    """
    bounds = _bounds(spark, table)
    touched = sorted(r[RANGE] for r in keys.select(_range_of(named(key), bounds).alias(RANGE)).distinct().collect())
    if not touched:
        return []
    stored = spark.table(table)
    base = stored.where(F.col(RANGE).isin(touched)).drop(RANGE)
    new = change(base).select(*map(named, base.columns)).withColumn(RANGE, _range_of(named(rowkey), bounds))
    seen = Observation()
    placed = new.repartition(len(touched), RANGE).sortWithinPartitions(RANGE, named(rowkey))
    rows = placed.observe(seen, F.collect_set(RANGE).alias("written"))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for gone in sorted(set(touched) - set(seen.get["written"])):
        _drop_range(spark, table, gone)
    return touched


def _drop_range(spark: SparkSession, table: str, number: int) -> None:
    """Spark leaves the files of tables with a path of their own, so they are removed by name."""
    files = spark.table(table).where(F.col(RANGE) == number).inputFiles()
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({RANGE} = {number})")
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def upsert_ranged_cells(spark: SparkSession, table: str, puts: DataFrame, *, order_by=("ts",), base_is_latest: bool = True) -> list[int]:
    """:func:`~keyloom.operators.mutate.upsert_cells` in place, in the ranges that ``puts`` fall in."""
    return rewrite_ranges(spark, table, puts, lambda base: upsert_cells(base, puts, order_by=order_by, base_is_latest=base_is_latest, broadcast_limit=BROADCAST_LIMIT))


def upsert_ranged_column(spark: SparkSession, table: str, puts: DataFrame, column: str, *, rowkey: str = "rowkey", order_by=()) -> list[int]:
    """:func:`~keyloom.operators.mutate.upsert_column` in place, in the ranges that ``puts`` fall in."""
    change = lambda base: upsert_column(base, puts, column, rowkey=rowkey, order_by=order_by, broadcast_limit=BROADCAST_LIMIT)
    return rewrite_ranges(spark, table, puts, change, rowkey=rowkey, key=rowkey)


def delete_ranged(spark: SparkSession, table: str, keys: DataFrame, *, rowkey: str = "rowkey", key: str = "rowkey") -> list[int]:
    """:func:`~keyloom.operators.mutate.delete_rows` in place, in the ranges that ``keys`` fall in."""
    change = lambda base: delete_rows(base, keys, rowkey=rowkey, key=key, broadcast_limit=BROADCAST_LIMIT)
    return rewrite_ranges(spark, table, keys, change, rowkey=rowkey, key=key)


def ranged_rows(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a ranged table, without the number of the range."""
    return spark.table(table).drop(RANGE)


def ranged_scan(spark: SparkSession, table: str, begin: str, end: str, *, rowkey: str = "rowkey") -> DataFrame:
    """:func:`~keyloom.operators.reads.range_scan`; ranges that have no such key are not listed."""
    bounds = _bounds(spark, table)
    last = end + RANGE_END_SUFFIX
    wanted = [
        n for i, (least, n) in enumerate(bounds) if (i == 0 or least is None or least.encode() < last.encode()) and (i + 1 == len(bounds) or (bounds[i + 1][0] or "").encode() >= begin.encode())
    ]
    rows = spark.table(table).where(F.col(RANGE).isin(wanted)) if wanted else spark.table(table).where(F.lit(False))
    return range_scan(rows.drop(RANGE), begin, end, rowkey)
