"""Every registered query against its SQL equivalent, values, names and types."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as contract
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

DATA = Path("/root/testdata")

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}

# Their column order is part of the result.
IN_ORDER = {"lookup_left", "lookup_column_order", "sink_append", "sink_append_by_name", "sink_ctas", "sink_recreate"}


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name, scale):
    folder = DATA / scale
    con = duckdb.connect()
    for file in folder.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    expected = con.execute(ORACLE[name])
    want_types = {d[0]: str(d[1]) for d in expected.description}
    want = expected.fetchall()

    df = QUERIES[name](spark, str(folder))
    if name in IN_ORDER:
        assert df.columns == list(want_types)
    columns = sorted(df.columns)
    assert columns == sorted(want_types)
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == want_types
    assert not any(isinstance(f.dataType, T.NullType) for f in df.schema.fields)

    at = [list(want_types).index(c) for c in columns]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert ordered(got) == ordered([tuple(row[i] for i in at) for row in want])
    assert got or scale == "sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["order_code", "o_totalprice", "nm", "seg"]
    assert df.count() == 1500
