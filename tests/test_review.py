"""One answer whatever the plan, names with dots, placement, by-name sinks, the command line."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import keyloom as kl
from keyloom.operators import keyjoin
from keyloom.plans.job import main
from tests.helpers import plan_of, rows
from workloads.queries import QUERIES
from workloads.scratch import new_table

CELL = "rowkey string, family string, qualifier string, ts int, value string"


@pytest.mark.parametrize("limit", [None, 0, 1 << 20])
def test_size_of_puts_changes_no_answer(spark, limit):
    base = spark.createDataFrame([("a", "f", "q", 1, "x"), ("a", "f", "q", 2, "y"), ("b", None, "q", 1, "z"), ("c", "f", "q", 9, "new")], CELL)
    puts = spark.createDataFrame([("a", "f", "q", 5, "put"), ("b", None, "q", 5, "put"), ("c", "f", "q", 1, "old"), ("d", "f", None, 1, "added"), ("d", "f", None, 0, "lower")], CELL)
    got = rows(kl.upsert_cells(base, puts, base_is_latest=True, broadcast_limit=limit))
    assert got == sorted([("a", "f", "q", 5, "put"), ("a", "f", "q", 5, "put"), ("b", None, "q", 5, "put"), ("c", "f", "q", 9, "new"), ("d", "f", None, 1, "added")], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_placement_is_exact_and_reads_once(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    placed = kl.repartition_by_key(df, "k", 6, ["hot"])
    assert plan_of(placed).count("Range (") == 1
    assert placed.rdd.getNumPartitions() == 6
    assert placed.where("k = 'hot'").select(F.spark_partition_id()).distinct().count() == 6


def test_key_reads_reach_the_scan(spark):
    assert "EqualTo(c_name" in plan_of(QUERIES["get_row"](spark, "/root/testdata/sf0.01"))
    plan = plan_of(QUERIES["range_scan"](spark, "/root/testdata/sf0.01"))
    assert "GreaterThanOrEqual(p_brand" in plan and "LessThan(p_brand" in plan
    plan = plan_of(QUERIES["range_scan_family"](spark, "/root/testdata/sf0.01"))
    assert "GreaterThanOrEqual(p_brand" in plan and "LessThan(p_brand" in plan
    assert "EqualTo(event_type,click)" in plan_of(QUERIES["get_row_latest"](spark, "/root/testdata/sf0.01"))


def test_ranges_of_numbers_are_in_text_order(spark):
    assert kl.range_scan(spark.range(130).withColumnRenamed("id", "rowkey"), "10", "12").count() == 23


def test_names_with_dots(spark):
    cells = spark.createDataFrame([("1", "f1", "q.x", 1, "v")], CELL)
    wide = kl.cells_to_wide(cells, ["q.x"])
    main_rows = spark.createDataFrame([("1", 5), ("2", 6)], "k string, `m.n` int")
    got = kl.lookup_enrich(main_rows, wide, "k", [("q.x", "out.x")], require=["out.x"])
    assert got.columns == ["m.n", "out.x"] and rows(got) == [(5, "v")]
    asked = kl.multi_get(spark.createDataFrame([("1",)], "rowkey string"), wide)
    assert rows(asked) == [("1", "v")]


def test_clashes_raise(spark):
    df = spark.createDataFrame([(1, "a")], "id int, k string")
    with pytest.raises(ValueError, match="lookup key"):
        kl.project_main(df, [("id", "k")], "k")
    with pytest.raises(ValueError, match="named twice"):
        kl.lookup_enrich(df, df.withColumnRenamed("k", "rowkey"), "k", [("id", "ID")])


def test_by_name_needs_a_table_and_takes_any_format(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        kl.append(df, "keyloom_no_such_table", by_name=True)
    name, path = new_table(spark, "orc")
    spark.sql(f"CREATE TABLE {name} (a INT, b STRING) USING orc LOCATION '{path}'")
    kl.append(df, name, by_name=True)
    assert rows(spark.table(name)) == [(1, "x")]


def test_command_line_looks_up(spark):
    (orders, p1), (customers, p2), (sink, p3) = (new_table(spark, k) for k in ("cli_main", "cli_dim", "cli_sink"))
    spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, ck string").write.option("path", p1).saveAsTable(orders)
    spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("", "no", 1)], "rowkey string, nm string, v int").write.option("path", p2).saveAsTable(customers)
    spark.sql(f"CREATE TABLE {sink} (id INT, nm STRING) USING parquet LOCATION '{p3}'")
    main(["--main", orders, "--key", "ck", "--dimension", f"{customers}:d:rowkey:v", "--fields", "nm", "--sink", sink])
    assert rows(spark.table(sink)) == [(1, "new"), (2, None), (3, None)]
    view = f"{customers}_view"
    main(["--dimension", f"{customers}:{view}:rowkey:v", "--sql", f"SELECT o.id, d.nm FROM {orders} o JOIN {view} d ON o.ck = d.rowkey", "--sink", sink, "--by-name"])
    assert spark.table(sink).where("nm = 'new'").count() == 2


def test_one_list_of_both_sides(spark):
    main_rows = spark.createDataFrame([("1", 5), ("", 6)], "k string, m int")
    dim = spark.createDataFrame([("1", "x", "y")], "rowkey string, a string, `b.c` string")
    items = [("dim", "b.c", "second"), ("main", "m", "n"), ("dim", "a", "k"), ("main", "k", "own")]
    got = kl.lookup_select(main_rows, dim, "k", items)
    assert got.columns == ["n", "own", "second", "k"]
    assert rows(got) == [(5, "1", "y", "x"), (6, "", None, None)]
    with pytest.raises(ValueError, match="sides"):
        kl.lookup_select(main_rows, dim, "k", [("other", "a", "a")])


def test_versions_are_measured_before_they_are_reduced(spark, monkeypatch):
    seen = []

    def within(df, limit=None):
        seen.append(plan_of(df))
        return True

    monkeypatch.setattr(keyjoin, "fits_in_broadcast", within)
    main_rows = spark.createDataFrame([("1", 5), ("2", 6)], "k string, m int")
    dim = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("", "none", 1)], "rowkey string, a string, v int")
    got = kl.lookup_enrich(main_rows, dim, "k", ["a"], order_by_version="v", broadcast_limit=1 << 20)
    assert rows(got) == [(5, "new"), (6, None)]
    assert len(seen) == 1 and "Aggregate" not in seen[0] and "Exchange" not in seen[0]
