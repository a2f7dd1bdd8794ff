"""Names with dots, and columns named like helpers, in every public function that joins or reduces."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

import keyloom as kl
from keyloom.plans import SETTINGS
from tests.helpers import rows, settings

HELPERS = ["__salt", "__right_salt", "__rowkey", "__dim_0", "__version", "__key", "__known", "__new", "key_part", "key_words", "__lookup_key", "__row", "__cell"]


@pytest.fixture
def main(spark):
    data = [(i, ["7", "8", "9", "", None, "no"][i % 6]) for i in range(60)]
    df = spark.createDataFrame(data, "n INT, `k.ey` STRING")
    return df.select("*", *[F.col("n").alias(h) for h in HELPERS])


@pytest.fixture
def dim(spark):
    data = [("7", "seven", 1, 0), ("8", "eight", 1, 0), ("8", "eight!", 2, 0), ("9", None, 1, 0), ("", "empty", 1, 0)]
    return spark.createDataFrame(data, "`row.key` STRING, `va.lue` STRING, `ver.sion` INT, `__row` INT")


OPTIONS = [
    {},
    {"hot_keys": ["7"]},
    {"hot_share": 0.1, "split_null_keys": True},
    {"hot_share": 0.9},
    {"split_null_keys": True},
    {"partitions": 3},
    {"unknown_share": 0.1},
    {"unknown_share": 0.1, "hot_share": 0.1, "partitions": 3},
    {"broadcast_limit": 1 << 20},
    {"broadcast_limit": 1 << 20, "partitions": 2},
]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_lookups(spark, main, dim, options):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        got = kl.lookup_enrich(main, dim, "k.ey", [("va.lue", "new.name")], rowkey="row.key", order_by_version="ver.sion", **options)
        found = {"7": "seven", "8": "eight!"}
        assert got.columns == ["n", *HELPERS, "new.name"]
        want = [(r["n"], *[r["n"]] * len(HELPERS), found.get(r["k.ey"])) for r in main.collect()]
        assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_select_views_and_duplicates(spark, main, dim):
    got = kl.lookup_select(main, dim.where("`ver.sion` = 1"), "k.ey", [("dim", "va.lue", "x.y"), ("main", "n", "__lookup_key")], rowkey="row.key")
    assert got.columns == ["__lookup_key", "x.y"] and got.where("`x.y` = 'eight'").count() == 10
    kl.register_dimension(dim, "names_dim", rowkey="row.key", order_by_version="ver.sion")
    main.createOrReplaceTempView("names_main")
    assert spark.sql("SELECT m.n, d.`va.lue` v FROM names_main m JOIN names_dim d ON m.`k.ey` = d.`row.key`").where("v = 'eight!'").count() == 10
    kl.register_lookup(main, dim, "names_view", "k.ey", [("va.lue", "v.alue")], rowkey="row.key", order_by_version="ver.sion")
    assert spark.sql("SELECT `k.ey` FROM names_view WHERE `v.alue` = 'seven'").distinct().collect()[0][0] == "7"
    assert [r["row.key"] for r in kl.duplicate_keys(dim, "row.key").collect()] == ["8"]


def test_reads_and_places(spark, main, dim):
    one = dim.where("`ver.sion` = 1")
    assert kl.get_row(dim, "7", "row.key").count() == kl.get_rows(dim, ["7"], "row.key").count() == 1
    assert kl.range_scan(dim, "7", "8", "row.key").count() == 3
    got = kl.multi_get(main.select("n", "`k.ey`", "__rowkey"), one.drop("__row"), key="k.ey", rowkey="row.key")
    assert got.columns == ["n", "k.ey", "__rowkey", "va.lue", "ver.sion"] and got.where("`va.lue` = 'eight'").count() == 10
    assert kl.get_cells(one, main, ["va.lue"], rowkey="row.key", key="k.ey").where("qualifier = 'va.lue'").count() == 2
    assert kl.repartition_by_key(main, "k.ey", 3, ["7"]).count() == 60
    assert sum(df.count() for df in kl.split_by_key(main, "k.ey", ["7"])) == 60
    assert kl.find_hot_keys(main, "k.ey", 0.2) == ["7", "8", "9", "no"]


def test_changes(spark, main, dim):
    one = dim.where("`ver.sion` = 1 and `row.key` != ''")
    gone = main.where("`k.ey` = '7'")
    assert kl.delete_rows(one, gone, rowkey="row.key", key="k.ey").count() == 2
    assert kl.delete_row(one, "7", rowkey="row.key").count() == 2
    puts = spark.createDataFrame([("7", "put"), ("new", "put")], "`row.key` STRING, `va.lue` STRING")
    for limit in (None, 1 << 20):
        got = kl.upsert_column(one, puts, "va.lue", rowkey="row.key", broadcast_limit=limit)
        assert got.columns == one.columns and {(r["row.key"], r["va.lue"]) for r in got.collect()} == {("7", "put"), ("new", "put"), ("8", "eight"), ("9", None)}


def test_cells(spark):
    schema = "rowkey STRING, family STRING, qualifier STRING, ts INT, value STRING, `ex.tra` INT, `__cell_` INT"
    cells = spark.createDataFrame([("a", "f1", "q.r", 1, "x", 5, 0), ("a", "f1", "q.r", 2, "y", 6, 0)], schema)
    assert rows(kl.latest_cells(cells)) == [("a", "f1", "q.r", 2, "y", 6, 0)]
    assert rows(kl.upsert_cells(cells, cells.withColumn("ts", F.col("ts") + 5))) == [("a", "f1", "q.r", 7, "y", 6, 0)]
    keys = spark.createDataFrame([("a",)], "`k.ey` STRING")
    assert rows(kl.get_latest_cells(cells, keys, ["q.r"], key="k.ey")) == [("a", "f1", "q.r", 2, "y", 6, 0)]
    assert rows(kl.cells_to_wide(cells, ["q.r"])) == [("a", "y")]
    wide = spark.createDataFrame([("a", 1, "v")], "`row.key` STRING, `t.s` INT, `q.r` STRING")
    assert rows(kl.wide_to_cells(wide, {"q.r": "f1"}, rowkey="row.key", ts="t.s")) == [("a", "f1", "q.r", 1, "v")]


def test_sinks(spark, dim):
    name = f"names_{uuid.uuid4().hex[:8]}"
    kl.save_ranged(dim, name, 2, rowkey="row.key")
    assert kl.delete_ranged(spark, name, dim.where("`row.key` = '7'"), rowkey="row.key", key="row.key")
    assert kl.ranged_rows(spark, name).count() == 4


def test_session_settings_of_the_user_stay(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "7m")
        kl.apply_settings(spark)
        assert spark.conf.get(name) == "7m"
        spark.conf.unset(name)
        kl.apply_settings(spark)
        assert spark.conf.get(name) == SETTINGS[name]
    finally:
        spark.conf.set(name, before)
