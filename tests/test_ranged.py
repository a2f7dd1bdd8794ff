"""Tables in key ranges: what a change rewrites, and keyed files that reads leave closed."""

from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import keyloom as kl
from keyloom.sinks import ranged
from tests.helpers import metric, rows


def files(path):
    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


def part(file):
    return int(file.split("=")[1].split("/")[0])


@pytest.fixture
def stored(spark, tmp_path):
    """1,000 keys in ten ranges, wide."""
    name, path = f"ranged_{uuid.uuid4().hex[:8]}", f"{tmp_path}/t"
    df = spark.range(1000).select(F.format_string("k%04d", "id").alias("rowkey"), F.col("id").cast("string").alias("a"), F.lit("x").alias("b.c"))
    kl.save_ranged(df, name, 10, path=path)
    return name, path, df


def test_only_touched_ranges_are_rewritten(spark, stored):
    name, path, df = stored
    before = files(path)
    assert len(before) == 10
    puts = spark.createDataFrame([("k0005", "new"), ("k0007", None), ("k0500", "mid"), ("zzz", "last"), ("a", "first"), ("k0500b", "between")], "rowkey STRING, a STRING")
    touched = kl.upsert_ranged_column(spark, name, puts, "a")
    after = files(path)
    kept = {f for f in before if part(f) not in touched}
    assert 2 < len(kept) < 10 and kept <= after
    assert not {f for f in before - kept} & after and len(after) == 10
    want = kl.upsert_column(df, puts, "a")
    assert rows(kl.ranged_rows(spark, name)) == rows(want)
    assert kl.ranged_rows(spark, name).columns == ["rowkey", "a", "b.c"]
    # New keys are in the range that later changes look for them in.
    kl.delete_ranged(spark, name, puts.select("rowkey").where("rowkey in ('zzz', 'a', 'k0500b')"))
    assert kl.ranged_rows(spark, name).count() == 1000


def test_emptied_ranges_are_dropped_and_filled_again(spark, stored):
    name, path, df = stored
    gone = df.where("rowkey < 'k0150'").select("rowkey")
    kl.delete_ranged(spark, name, gone)
    assert rows(kl.ranged_rows(spark, name)) == rows(df.where("rowkey >= 'k0150'"))
    assert len(files(path)) < 10
    kl.upsert_ranged_column(spark, name, df.where("rowkey < 'k0150'").select("rowkey", "a"), "a")
    assert kl.ranged_rows(spark, name).count() == 1000
    assert kl.delete_ranged(spark, name, df.select("rowkey")) == list(range(10)) and kl.ranged_rows(spark, name).count() == 0


def test_nothing_to_change(spark, stored):
    name, path, df = stored
    before = files(path)
    assert kl.delete_ranged(spark, name, df.select("rowkey").limit(0)) == []
    assert files(path) == before
    with pytest.raises(ValueError, match="ranges"):
        kl.save_ranged(df, "too_many", 1_000_000)
    with pytest.raises(ValueError, match="column of the rows"):
        kl.save_ranged(df.withColumn(ranged.RANGE, F.lit(1)), "clash", 2)


def test_a_failed_change_leaves_the_table(spark, stored):
    name, path, df = stored
    before = files(path)
    with pytest.raises(Exception, match="stop"):
        kl.rewrite_ranges(spark, name, df.select("rowkey").limit(5), lambda base: base.withColumn("a", F.raise_error(F.lit("stop")).cast("string")))
    assert files(path) == before and rows(kl.ranged_rows(spark, name)) == rows(df)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_cells_in_ranges(spark, tmp_path):
    cells = spark.range(300).select(
        F.format_string("r%03d", F.col("id") % 60).alias("rowkey"), F.lit("f1").alias("family"), (F.col("id") % 5).cast("string").alias("qualifier"), F.lit(1).alias("ts"), F.col("id").cast("string").alias("value")
    ).dropDuplicates(["rowkey", "family", "qualifier"])
    name = f"cells_{uuid.uuid4().hex[:8]}"
    kl.save_ranged(cells, name, 6, path=f"{tmp_path}/c")
    puts = spark.createDataFrame([("r001", "f1", "1", 2, "put"), ("r059", "f2", "q", 2, "new"), (None, "f1", "q", 2, "no key")], "rowkey STRING, family STRING, qualifier STRING, ts INT, value STRING")
    kl.upsert_ranged_cells(spark, name, puts)
    assert rows(kl.ranged_rows(spark, name)) == rows(kl.upsert_cells(cells, puts, base_is_latest=True))


def test_range_scan_lists_few_ranges(spark, stored):
    name, _, df = stored
    for begin, end in (("k0100", "k0120"), ("", "k0003"), ("k0990", "z"), ("k03", "k03"), ("x", "y")):
        got = kl.ranged_scan(spark, name, begin, end)
        assert rows(got) == rows(kl.range_scan(df, begin, end))
        assert len(got.inputFiles()) <= 3


def test_many_bounds_are_searched_in_two_steps(spark):
    bounds = [(f"{i:04d}", i) for i in range(0, 1050)]
    keys = spark.createDataFrame([("",), (None,), ("0000",), ("0099",), ("0100",), ("0100x",), ("0999",), ("1049",), ("zz",)], "k STRING")
    got = [r[0] for r in keys.select(ranged._range_of(F.col("k"), bounds)).collect()]
    assert got == [0, 0, 0, 99, 100, 100, 999, 1049, 1049]


def test_manifest_opens_only_files_with_such_keys(spark, tmp_path):
    df = spark.range(10_000).select(F.format_string("k%05d", "id").alias("rowkey"), "id")
    kl.write_keyed(df, f"{tmp_path}/t", partitions=16)
    got = kl.read_key_range(spark, f"{tmp_path}/t", "k01000", "k01999")
    assert rows(got) == rows(kl.range_scan(df, "k01000", "k01999")) and got.count() == 1000
    assert 1 <= len(got.inputFiles()) <= 4
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10_000  # the manifest is no part of the table
    none = kl.read_key_range(spark, f"{tmp_path}/t", "x", "z")
    assert none.count() == 0 and none.columns == ["rowkey", "id"]
    kl.write_keyed(df.where("id < 10").withColumn("rowkey", F.concat(F.lit("x"), "rowkey")), f"{tmp_path}/t", mode="append")
    assert kl.read_key_range(spark, f"{tmp_path}/t", "xk", "xz").count() == 10


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """Keys without order: every file's least and greatest key span nearly all, only the filters tell."""
    df = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("rowkey"), "id")
    kl.write_keyed(df, f"{tmp_path}/plain", sort=False, partitions=8)
    kl.write_keyed(df, f"{tmp_path}/bloom", sort=False, partitions=8, keys_per_file=10_000)
    keys = [r["rowkey"] for r in df.where("id in (5, 77)").collect()]
    read = {}
    for kind in ("plain", "bloom"):
        got = kl.get_rows(spark.read.parquet(f"{tmp_path}/{kind}"), keys)
        assert sorted(r["id"] for r in got.collect()) == [5, 77]
        (read[kind],) = metric(got, "Scan parquet", "numOutputRows")
    assert read["plain"] == 40_000 and read["bloom"] <= 10_500

    many = [*keys, *(f"no such key {i}" for i in range(35)), None]
    got = kl.get_rows(spark.read.parquet(f"{tmp_path}/bloom"), many)
    assert sorted(r["id"] for r in got.collect()) == [5, 77]
    assert metric(got, "Scan parquet", "numOutputRows")[0] <= 20_500
    assert kl.get_rows(df, []).count() == 0


def test_multi_get_of_few_keys(spark, tmp_path):
    df = spark.range(5_000).select(F.sha2(F.col("id").cast("string"), 256).alias("rowkey"), "id")
    kl.write_keyed(df, f"{tmp_path}/t", sort=False, partitions=4, keys_per_file=5_000)
    table = spark.read.parquet(f"{tmp_path}/t")
    asked = df.where("id < 3").select(F.col("id").alias("pos"), "rowkey").unionByName(spark.createDataFrame([(9, None), (10, "none"), (11, "none")], "pos BIGINT, rowkey STRING"))
    few, plain = kl.multi_get(asked, table, few_keys=4), kl.multi_get(asked, table)
    assert rows(few) == rows(plain)
    assert "rowkey IN" in few._jdf.queryExecution().optimizedPlan().toString() or "In(" in few._jdf.queryExecution().toString()
    assert rows(kl.multi_get(asked, table, few_keys=2)) == rows(plain)  # more keys than that: the plain plan
