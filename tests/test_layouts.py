"""Salted main tables and compacted cell tables: what is stored, how it is read, and odd input."""

from __future__ import annotations

import uuid
from statistics import median

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import keyloom as kl
from tests.helpers import plan_of, rows, settings

N, BUCKETS = 40_000, 8


def fresh(kind):
    return f"{kind}_{uuid.uuid4().hex[:8]}"


@pytest.fixture(scope="module")
def main(spark):
    """A third of the rows ask for one key, a fifth have none, the rest are spread."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).when(F.col("id") % 10 == 2, "").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, N, 1, 8).select("id", key.alias("k")).checkpoint()


@pytest.fixture(scope="module")
def dim(spark):
    keys = F.when(F.col("id") == 0, "hot").when(F.col("id") == 1, "").otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(4000).select(keys.alias("rowkey"), F.concat(F.lit("n"), F.col("id")).alias("nm")).checkpoint()


@pytest.fixture(scope="module")
def salted(spark, main, dim):
    name, side = fresh("salted"), fresh("salted_dim")
    kl.save_salted(main, name, BUCKETS, "k")
    kl.save_salted_dimension(dim, side, name, BUCKETS)
    return name, side


def file_rows(spark, table):
    return [r["n"] for r in spark.table(table).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]


def test_files_of_a_hot_main_are_even(spark, main, salted):
    even = file_rows(spark, salted[0])
    assert len(even) == BUCKETS and sum(even) == N and max(even) < 2 * median(even)
    plain = fresh("plain")
    kl.save_bucketed(main, plain, BUCKETS, rowkey="k")
    assert max(file_rows(spark, plain)) > 2 * median(file_rows(spark, plain))


def test_salts_stay_with_their_share(spark, salted):
    hot = {r["hot_key"]: r["salts"] for r in spark.table(f"{salted[0]}_hot").collect()}
    assert set(hot) == {"hot"} and 85 <= hot["hot"] <= 87  # 32 * 8 / 3
    assert spark.table(salted[0]).where("k like 'k%' and key_salt != 0").count() == 0
    assert spark.table(salted[0]).where("k is null").select("key_salt").distinct().count() > BUCKETS
    copies = spark.table(salted[1])
    assert copies.where("rowkey = 'hot'").count() == hot["hot"] and copies.where("rowkey = ''").count() == 0
    assert copies.where("rowkey != 'hot'").groupBy("rowkey").count().where("count > 1").count() == 0


@pytest.mark.parametrize("options", [{}, {"require": ["nm"]}, {"broadcast_limit": 1 << 20}, {"unknown_share": 0.01}])
@pytest.mark.parametrize("side", ["plain", "copied"])
def test_salted_lookup_is_the_lookup(spark, main, dim, salted, side, options):
    right = dim if side == "plain" else spark.table(salted[1])
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        got = kl.lookup_salted(spark, salted[0], right, "k", [("nm", "nm")], **options)
        assert got.columns == ["id", "nm"]
        require = {"require": options["require"]} if "require" in options else {}
        assert rows(got) == rows(kl.lookup_enrich(main, dim, "k", [("nm", "nm")], **require))


def test_a_salted_main_is_not_shuffled(spark, dim, salted):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(kl.lookup_salted(spark, salted[0], dim, "k", ["nm"]))
        assert plan.count("Exchange hashpartitioning") == 1  # the dimension's
        both = plan_of(kl.lookup_salted(spark, salted[0], spark.table(salted[1]), "k", ["nm"]))
        assert "Exchange" not in both and "Join" in both


def test_versions_of_a_plain_dimension(spark, main, dim, salted):
    versions = dim.withColumn("v", F.lit(1)).unionByName(dim.withColumn("v", F.lit(2)).withColumn("nm", F.upper("nm")))
    got = kl.lookup_salted(spark, salted[0], versions, "k", ["nm"], order_by_version="v")
    assert rows(got) == rows(kl.lookup_enrich(main, dim.withColumn("nm", F.upper("nm")), "k", ["nm"]))
    with pytest.raises(ValueError, match="versions"):
        kl.lookup_salted(spark, salted[0], spark.table(salted[1]), "k", ["nm"], order_by_version="nm")


def test_odd_mains(spark, dim):
    schema = "id INT, k STRING, m MAP<STRING,INT>"
    for data in ([], [(1, None, None)] * 40, [(1, "hot", {"a": 1})] * 40 + [(2, "", None)]):
        name, odd = fresh("odd"), spark.createDataFrame(data, schema)
        kl.save_salted(odd, name, 4, "k")
        got = kl.lookup_salted(spark, name, dim, "k", ["nm"])
        assert got.columns == ["id", "m", "nm"]
        assert rows(got.drop("m")) == rows(kl.lookup_enrich(odd.drop("m"), dim, "k", ["nm"]))
    with pytest.raises(ValueError, match="key_salt"):
        kl.save_salted(dim.withColumn("key_salt", F.lit(1)), fresh("odd"), 4, "rowkey")
    with pytest.raises(ValueError, match="buckets"):
        kl.save_salted(dim, fresh("odd"), 0, "rowkey")


@pytest.fixture(scope="module")
def cells(spark):
    """Three versions of each of 6000 cells, in 1000 rows."""
    return spark.range(18_000).select(
        F.concat(F.lit("r"), F.col("id") % 1000).alias("rowkey"),
        F.lit("f1").alias("family"),
        F.concat(F.lit("q"), F.floor(F.col("id") / 1000) % 6).alias("qualifier"),
        F.floor(F.col("id") / 6000).alias("ts"),
        F.col("id").cast("string").alias("value"),
    ).checkpoint()


def test_compacted_cells_are_a_scan(spark, cells):
    name = fresh("compact")
    assert kl.compact_cells(cells, name, 4) == "row"
    latest = kl.compacted_cells(spark, name)
    assert rows(latest) == rows(kl.latest_cells(cells)) and latest.count() == 6000
    plan = plan_of(latest)
    assert "Exchange" not in plan and "Sort" not in plan and "Aggregate" not in plan
    wide = kl.cells_to_wide(latest, ["q0", "q5"])
    assert "Exchange" not in plan_of(wide) and rows(wide) == rows(kl.cells_to_wide(cells, ["q0", "q5"]))
    assert kl.versions_left(spark, name).count() == 0
    with pytest.raises(AnalysisException):
        kl.compact_cells(cells, name, 4)


def test_a_row_with_very_many_cells_is_spread(spark, cells):
    big = spark.range(9000).select(F.lit("big").alias("rowkey"), F.lit("f1").alias("family"), F.col("id").cast("string").alias("qualifier"), F.lit(1).cast("bigint").alias("ts"), F.lit("v").alias("value"))
    both, name = cells.unionByName(big), fresh("compact")
    assert kl.compact_cells(both, name, 8) == "cell"
    sizes = file_rows(spark, name)
    assert len(sizes) == 8 and max(sizes) < 2 * median(sizes)
    assert rows(kl.compacted_cells(spark, name)) == rows(kl.latest_cells(both))
    assert "Exchange" not in plan_of(kl.compacted_cells(spark, name))


def test_a_delta_leaves_the_table_in_place(spark, cells):
    name, again = fresh("compact"), fresh("compact")
    kl.compact_cells(cells, name, 4)
    schema = "rowkey STRING, family STRING, qualifier STRING, ts BIGINT, value STRING"
    delta = spark.createDataFrame(
        [("r1", "f1", "q0", 99, "new"), ("r1", "f1", "q1", -1, "old"), ("r2", "f1", "q0", 99, None), ("x", "f1", "q0", 0, "added"), ("r1", "f1", "q0", 98, "older")], schema
    )
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        merged = kl.compacted_cells(spark, name, delta)
        want = {(r[0], r[1], r[2]): tuple(r) for r in kl.latest_cells(cells).collect()}
        want[("r1", "f1", "q0")] = ("r1", "f1", "q0", 99, "new")
        want[("x", "f1", "q0")] = ("x", "f1", "q0", 0, "added")
        assert rows(merged) == sorted(want.values(), key=lambda r: tuple((v is None, str(v)) for v in r))
        plan = plan_of(merged)
        assert "SortMergeJoin" not in plan and "FullOuter" not in plan
        assert kl.compact_cells(merged, again, 4, is_latest=True) == "row"
        large = kl.compacted_cells(spark, name, delta, broadcast_limit=1)
        assert rows(large) == rows(merged) == rows(spark.table(again))


def test_odd_cells(spark, cells):
    name = fresh("compact")
    kl.compact_cells(kl.empty_cells(spark), name, 4)
    assert kl.compacted_cells(spark, name).count() == 0
    odd = spark.createDataFrame([(None, None, "q", 1, "a", "x"), (None, None, "q", 2, "", "y"), ("r", "f1", "", 1, "b", None), ("r", "f1", "", 1, "b", None)], "rowkey STRING, family STRING, qualifier STRING, ts BIGINT, value STRING, `n.m` STRING")
    name = fresh("compact")
    kl.compact_cells(odd, name, 2)
    assert rows(kl.compacted_cells(spark, name)) == rows(odd.where("value = '' or rowkey = 'r'").distinct())
    with pytest.raises(ValueError, match="by is"):
        kl.compact_cells(cells, fresh("compact"), 2, by="value")
    with pytest.raises(ValueError, match="buckets"):
        kl.compact_cells(cells, fresh("compact"), 0)
