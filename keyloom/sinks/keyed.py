"""Keyed tables laid out for what is read from them later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.keys import named
from keyloom.operators.reads import RANGE_END_SUFFIX, range_scan

# Beside the files: name, least and greatest key of each. The underscore hides it from readers of the table.
MANIFEST = "_key_ranges"
# A read of more files than this lists the folder and leaves the choice to the pushed bounds.
MOST_FILES = 10_000


def write_keyed(
    df: DataFrame, path: str, *, by: Sequence[str] = ("rowkey",), partitions: int | None = None, mode: str = "errorifexists", sort: bool = True, keys_per_file: int | None = None
) -> None:
    """Parquet in key order, so that reads by key or key range skip files and row groups.

    For a cell table pass the whole cell key and the version in ``by``: the
    ranges then also cut through a row key that holds very many cells. A manifest of the
    files' first key column is written beside them, for :func:`read_key_range`.

    ``keys_per_file`` adds Bloom filters for about so many different keys to each row group, for reads by
    key where the order cannot help: with ``sort=False`` the rows stay in their files and order.
    """
    rows = df
    if sort:
        rows = df.repartitionByRange(*([partitions] if partitions else []), *map(named, by)).sortWithinPartitions(*map(named, by))
    elif partitions:
        rows = df.repartition(partitions)
    writer = rows.write.mode(mode)
    if keys_per_file:
        writer = writer.option(f"parquet.bloom.filter.enabled#{by[0]}", "true").option(f"parquet.bloom.filter.expected.ndv#{by[0]}", str(keys_per_file))
    writer.parquet(path)
    write_manifest(df.sparkSession, path, by[0])


def write_manifest(spark: SparkSession, path: str, rowkey: str = "rowkey") -> None:
    """Least and greatest key of each file of the keyed table at ``path``; reads its key column. Run it anew when files were added."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), named(rowkey).alias("key"))
    ranges = files.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("greatest"))
    ranges.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def read_key_range(spark: SparkSession, path: str, begin: str, end: str, rowkey: str = "rowkey") -> DataFrame:
    """:func:`~keyloom.operators.reads.range_scan` of the keyed table at ``path``, which opens only files that hold such keys.

    Keys must be strings. The manifest's bounds are filtered on Spark; names of ``MOST_FILES`` files at
    most come to the driver.
    """
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    if manifest.schema["least"].dataType.typeName() != "string":
        raise ValueError(f"{rowkey} is not a string")
    held = manifest.where((F.col("least") < end + RANGE_END_SUFFIX) & (F.col("greatest") >= begin))
    files = [r["file"] for r in held.select("file").limit(MOST_FILES + 1).collect()]
    if not files:
        return spark.read.parquet(path).where(F.lit(False))
    whole = len(files) > MOST_FILES
    rows = spark.read.parquet(path) if whole else spark.read.parquet(*(f"{path}/{f}" for f in sorted(files)))
    return range_scan(rows, begin, end, rowkey)


def save_bucketed(
    df: DataFrame, table: str, buckets: int, *, rowkey: str = "rowkey", path: str | None = None, mode: str = "errorifexists"
) -> None:
    """Table bucketed and sorted by key: lookups read it without a shuffle of this side.

    Rows are first brought together by bucket, so each bucket is one file. Use
    it for tables with one row per key.
    """
    writer = df.repartition(buckets, rowkey).write.mode(mode).bucketBy(buckets, rowkey).sortBy(rowkey)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
