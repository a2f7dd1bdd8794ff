"""The lookup join: what it keeps, what it appends, and that every plan gives the same rows."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import keyloom as kl
from tests.helpers import rows

MAIN = "id BIGINT, k STRING, tags ARRAY<STRING>"
DIM = "rowkey STRING, name STRING, n INT"

MAIN_ROWS = [
    (1, "a", ["x"]),
    (2, "b", None),
    (3, None, []),
    (4, "", ["y", "z"]),
    (5, "nope", ["x"]),
    (6, "a", ["x"]),
    (7, "c", None),
]
DIM_ROWS = [("a", "Ann", 1), ("b", "", 2), ("c", None, None), ("d", "unused", 4)]

OPTIONS = [
    {},
    {"broadcast_limit": 1 << 20},
    {"broadcast_limit": 0},
    {"split_null_keys": True},
    {"hot_keys": ["a"]},
    {"hot_keys": ["a", "nope"], "split_null_keys": True},
    {"hot_share": 0.2},
    {"partitions": 3},
    {"partitions": 3, "broadcast_limit": 1 << 20},
    {"partitions": 3, "hot_keys": ["a"], "broadcast_limit": 0},
]


@pytest.fixture
def main(spark):
    return spark.createDataFrame(MAIN_ROWS, MAIN)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(DIM_ROWS, DIM)


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_rows(main, dim, options):
    out = kl.lookup_enrich(main, dim, "k", [("name", "nm"), ("n", "num")], **options)
    assert out.columns == ["id", "tags", "nm", "num"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "array<string>", "string", "string"]
    assert all(f.nullable for f in out.schema.fields[2:])
    assert rows(out) == [
        (1, ["x"], "Ann", "1"),
        (2, None, "", "2"),
        (3, [], None, None),
        (4, ["y", "z"], None, None),
        (5, ["x"], None, None),
        (6, ["x"], "Ann", "1"),
        (7, None, None, None),
    ]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_require_keeps_empty_and_drops_absent(main, dim, options):
    out = kl.lookup_enrich(main, dim, "k", [("name", "nm")], require=["nm"], **options)
    assert [(r[0], r[2]) for r in rows(out)] == [(1, "Ann"), (2, ""), (6, "Ann")]


def test_field_under_two_aliases(main, dim):
    out = kl.lookup_enrich(main, dim, "k", [("name", "x"), ("n", "y"), ("name", "z")])
    assert out.columns == ["id", "tags", "x", "y", "z"]
    assert (1, ["x"], "Ann", "1", "Ann") in rows(out)


def test_no_fields(main, dim):
    out = kl.lookup_enrich(main, dim, "k", [])
    assert out.columns == ["id", "tags"]
    assert out.count() == len(MAIN_ROWS)


def test_key_is_dropped_unless_projected_twice(main, dim):
    kept = kl.project_main(main, ["id", ("k", "key_text")], "k")
    assert kl.lookup_enrich(kept, dim, "k", ["name"]).columns == ["id", "key_text", "name"]


def test_empty_row_key_in_dimension_is_never_found(spark, main):
    dim = spark.createDataFrame([("", "empty", 0), (None, "null", 0), ("a", "Ann", 1)], DIM)
    for options in OPTIONS:
        out = kl.lookup_enrich(main, dim, "k", ["name"], **options)
        assert {r[2] for r in rows(out)} == {"Ann", None}
        assert out.count() == len(MAIN_ROWS)


def test_number_keys_match_as_text(spark):
    main = spark.createDataFrame([(1, 10), (2, None)], "id INT, k BIGINT")
    dim = spark.createDataFrame([(10, "ten")], "rowkey INT, name STRING")
    for options in OPTIONS:
        options = {**options, "hot_keys": ["10"]} if "hot_keys" in options else options
        assert rows(kl.lookup_enrich(main, dim, "k", ["name"], **options)) == [(1, "ten"), (2, None)]
    assert rows(kl.repartition_by_key(main, "k", 2, ["10"])) == rows(main)
    text = spark.createDataFrame([("10", "ten"), ("x", "no number")], "rowkey STRING, name STRING")
    got = kl.multi_get(main, text, key="k", split_null_keys=True, hot_share=0.5)
    assert rows(got) == [(1, 10, "ten"), (2, None, None)]


def test_bytes_in_the_dimension_are_decoded(spark):
    main = spark.createDataFrame([(1, "é")], "id INT, k STRING")
    dim = spark.createDataFrame([(bytearray("é".encode()), bytearray(b"ok\xff"))], "rowkey BINARY, name BINARY")
    assert rows(kl.lookup_enrich(main, dim, "k", ["name"])) == [(1, "ok\ufffd")]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_latest_version_per_key(spark, main, options):
    dim = spark.createDataFrame(
        [("a", "old", 1, 1), ("a", "new", 2, 2), ("b", "x", 3, None), ("b", None, 4, 9), ("c", "p", 5, 7), ("c", "q", 6, 7)],
        "rowkey STRING, name STRING, n INT, v INT",
    )
    out = kl.lookup_enrich(main, dim, "k", ["name"], order_by_version="v", **options)
    assert [(r[0], r[2]) for r in rows(out)] == [
        (1, "new"),
        (2, None),
        (3, None),
        (4, None),
        (5, None),
        (6, "new"),
        (7, "q"),
    ]


def test_duplicate_keys_are_reported(spark):
    dim = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 3)], DIM)
    assert rows(kl.duplicate_keys(dim)) == [("a", 2)]


def test_clashing_names_and_unknown_requirements_are_refused(main, dim):
    with pytest.raises(ValueError, match="named twice"):
        kl.lookup_enrich(main, dim, "k", [("name", "id")])
    with pytest.raises(ValueError, match="named twice"):
        kl.lookup_enrich(main, dim, "k", [("name", "x"), ("n", "x")])
    with pytest.raises(ValueError, match="no output column"):
        kl.lookup_enrich(main, dim, "k", ["name"], require=["n"])


def test_lookup_from_cells(spark, main):
    cells = spark.createDataFrame(
        [
            ("a", "f1", "name", 1, "old"),
            ("a", "f1", "name", 2, "new"),
            ("a", "f2", "name", 3, "other family"),
            ("b", "f1", "name", 1, ""),
            ("b", "f1", "other", 9, "x"),
            ("c", "f1", "other", 9, "y"),
        ],
        "rowkey STRING, family STRING, qualifier STRING, ts INT, value STRING",
    )
    dim = kl.cells_to_wide(cells, ["name"])
    out = kl.lookup_enrich(main, dim, "k", ["name"])
    assert [(r[0], r[2]) for r in rows(out)] == [
        (1, "new"),
        (2, ""),
        (3, None),
        (4, None),
        (5, None),
        (6, "new"),
        (7, None),
    ]


keys = st.one_of(st.none(), st.sampled_from(["", "a", "b", "c", "é", "A", "a "]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    main=st.lists(keys, min_size=1, max_size=30),
    dim=st.dictionaries(st.sampled_from(["a", "b", "c", "d", "é"]), st.one_of(st.none(), st.text(max_size=3))),
)
def test_every_plan_agrees_with_brute_force(spark, main, dim):
    left = spark.createDataFrame(list(enumerate(main)), "id INT, k STRING")
    right = spark.createDataFrame(list(dim.items()), "rowkey STRING, name STRING")
    expected = sorted((i, dim.get(k) if k else None) for i, k in enumerate(main))
    for options in ({}, {"broadcast_limit": 1 << 20}, {"split_null_keys": True}, {"hot_keys": ["a", "d"]}):
        out = kl.lookup_enrich(left, right, "k", ["name"], **options)
        assert [(r[0], r[1]) for r in sorted(out.collect(), key=lambda r: r[0])] == expected


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_join_kinds_agree_over_plans(spark, main, dim, how):
    right = dim.select(dim.rowkey.alias("rk"), "name").where("rowkey in ('a', 'b', 'd')")
    answers = [rows(kl.join_by_key(main, "k", right, "rk", how, **o)) for o in OPTIONS]
    ids = {"left": [1, 2, 3, 4, 5, 6, 7], "left_semi": [1, 2, 6], "left_anti": [3, 4, 5, 7]}[how]
    assert [r[0] for r in answers[0]] == ids
    assert all(a == b for a, b in itertools.pairwise(answers))


def test_multi_get_keeps_order_duplicates_and_misses(spark, dim):
    requests = kl.requested(spark, ["b", "nope", "a", "b", None])
    out = kl.multi_get(requests, dim).orderBy("pos")
    assert [tuple(r) for r in out.collect()] == [
        (0, "b", "", 2),
        (1, "nope", None, None),
        (2, "a", "Ann", 1),
        (3, "b", "", 2),
        (4, None, None, None),
    ]
    assert kl.multi_get(kl.requested(spark, []), dim).count() == 0


def test_multi_get_refuses_shared_columns(spark, dim):
    with pytest.raises(ValueError, match="both"):
        kl.multi_get(spark.createDataFrame([("a", 1)], "rowkey STRING, n INT"), dim)


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_a_table_can_be_its_own_dimension(spark, options):
    people = [("1", "Ann", None), ("2", "Bo", "1"), ("3", "Cy", "2")]
    staff = spark.createDataFrame(people, "rowkey STRING, name STRING, boss STRING")
    out = kl.lookup_enrich(staff, staff, "boss", [("name", "boss_name")], **options)
    assert rows(out) == [("1", "Ann", None), ("2", "Bo", "Ann"), ("3", "Cy", "Bo")]
