"""Result tables and the job."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException

import keyloom as kl
from keyloom.plans.job import main as job_main
from tests.helpers import rows


@pytest.fixture
def sink(spark):
    name = f"sink_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (code INT, name STRING, seg STRING) USING parquet")
    return name


@pytest.fixture
def main(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, ""), (4, None)], "code INT, k STRING")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("a", "Ann", "s1"), ("b", "Bo", None)], "rowkey STRING, c_name STRING, c_seg STRING")


def test_append_is_positional_and_adds_up(spark, sink):
    df = spark.createDataFrame([(1, "x", "y")], "other INT, names STRING, differ STRING")
    kl.append(df, sink)
    kl.append(df, sink)
    assert rows(spark.table(sink)) == [(1, "x", "y")] * 2


def test_append_by_name(spark, sink):
    df = spark.createDataFrame([("y", 1, "x")], "seg STRING, code INT, name STRING")
    kl.append(df, sink, by_name=True)
    assert rows(spark.table(sink)) == [(1, "x", "y")]


def test_append_refuses_text_in_a_number_column(spark, sink):
    with pytest.raises(AnalysisException):
        kl.append(spark.createDataFrame([("x", "y", "z")], "a STRING, b STRING, c STRING"), sink)


def test_create_and_recreate(spark, main):
    name = f"made_{uuid.uuid4().hex[:8]}"
    kl.create_table_as(main, name)
    with pytest.raises(AnalysisException):
        kl.create_table_as(main, name)
    kl.recreate_table(main.select("code").where("code > 2"), name)
    assert rows(spark.table(name)) == [(3,), (4,)]


@pytest.mark.parametrize("partitions", [None, 3])
def test_job(spark, sink, main, dim, partitions):
    kl.run_enrichment(
        spark, main, dim, "k", [("c_name", "name"), ("c_seg", "seg")], sink=sink, partitions=partitions
    )
    assert rows(spark.table(sink)) == [(1, "Ann", "s1"), (2, "Bo", None), (3, None, None), (4, None, None)]


def test_job_by_table_names_with_required_field(spark, sink, main, dim):
    kl.recreate_table(main.withColumn("extra", main.code), f"{sink}_main")
    kl.recreate_table(dim, f"{sink}_dim")
    kl.run_enrichment(
        spark,
        f"{sink}_main",
        f"{sink}_dim",
        "k",
        [("c_seg", "seg"), ("c_name", "name")],
        columns=["code"],
        require=["seg"],
        sink=sink,
        by_name=True,
    )
    assert rows(spark.table(sink)) == [(1, "Ann", "s1")]


def test_sql_text(spark, sink, main, dim):
    main.createOrReplaceTempView("job_main")
    both = dim.unionByName(spark.createDataFrame([("", "Empty", "s9")], dim.schema))
    kl.register_dimension(both, "job_dim")
    text = "SELECT m.code, upper(d.c_name) AS name, d.c_seg AS seg FROM job_main m LEFT JOIN job_dim d ON m.k = d.rowkey"
    kl.run_sql_enrichment(spark, text, sink=sink)
    assert rows(spark.table(sink)) == [(1, "ANN", "s1"), (2, "BO", None), (3, None, None), (4, None, None)]
    star = spark.sql("SELECT m.*, d.* FROM job_main m LEFT JOIN job_dim d ON m.k = d.rowkey WHERE d.c_name > 'B'")
    assert rows(star) == [(2, "b", "b", "Bo", None)]


def test_registered_dimension_takes_the_latest_version(spark, main):
    dim = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "rowkey STRING, name STRING, v INT")
    main.createOrReplaceTempView("job_main")
    kl.register_dimension(dim, "job_versions", order_by_version="v")
    out = spark.sql("SELECT m.code, d.name, d.v FROM job_main m LEFT JOIN job_versions d ON m.k = d.rowkey")
    assert rows(out) == [(1, "new", 2), (2, None, None), (3, None, None), (4, None, None)]
    kl.register_dimension(dim.withColumn("wide", dim.v), "job_versions", fields=["name"], order_by_version="v")
    assert spark.table("job_versions").columns == ["rowkey", "name", "v"]


def test_submit_entry(spark, sink, main, dim):
    main.createOrReplaceTempView("submit_main")
    kl.register_dimension(dim, "submit_dim")
    job_main(
        [
            "--sql",
            "SELECT d.c_seg AS seg, m.code, d.c_name AS name FROM submit_main m LEFT JOIN submit_dim d ON m.k = d.rowkey"
            " WHERE d.c_seg IS NOT NULL",
            "--sink",
            sink,
            "--by-name",
        ]
    )
    assert rows(spark.table(sink)) == [(1, "Ann", "s1")]


def test_scratch_folder_is_never_machine_local_on_a_cluster():
    from workloads.scratch import shared_dir

    class Session:
        def __init__(self, **conf):
            self.values = {k.replace("__", "."): v for k, v in conf.items()}
            self.conf = self

        def get(self, name, default=None):
            return self.values.get(name, default)

    assert shared_dir(Session(spark__checkpoint__dir="hdfs:///shared/x/", spark__master="yarn")) == "hdfs:///shared/x"
    assert shared_dir(Session(spark__master="local[2]")).startswith("/tmp/run-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark__master="yarn"))


def test_sizes(spark):
    df = spark.createDataFrame([("abc", 1, ["x"]), (None, None, None)], "a STRING, b INT, c ARRAY<STRING>")
    assert 100 < kl.measured_bytes(df) < 300
    assert kl.measured_bytes(df.where("b = 5")) == 0
    assert kl.fits_in_broadcast(df, 300) and not kl.fits_in_broadcast(df, 10)


def test_a_run_with_an_id_is_there_once(spark):
    name = f"runs_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (code INT, name STRING, run_id STRING) USING parquet PARTITIONED BY (run_id)")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a INT, b STRING")
    for run in ("r1", "r1", "it's"):
        kl.append(df, name, run_id=run)
    assert rows(spark.table(name)) == [(1, "x", "it's"), (1, "x", "r1"), (2, "y", "it's"), (2, "y", "r1")]
    broken = df.selectExpr("a", "if(a = 2, raise_error('died'), b) as b")
    with pytest.raises(Exception, match="died"):
        kl.append(broken, name, run_id="r2")
    assert spark.table(name).where("run_id = 'r2'").count() == 0
    kl.append(df.select("b", "a").toDF("name", "code"), name, run_id="r2", by_name=True)
    assert rows(spark.table(name).where("run_id = 'r2'")) == [(1, "x", "r2"), (2, "y", "r2")]
    with pytest.raises(ValueError, match="columns"):
        kl.append(df.select("a"), name, run_id="r3")


def test_run_ids_need_their_column(spark, sink):
    with pytest.raises(ValueError, match="run_id"):
        kl.append(spark.createDataFrame([(1, "x", "y")], "a INT, b STRING, c STRING"), sink, run_id="r1")


def test_even_files(spark, tmp_path):
    from pathlib import Path

    from pyspark.sql import functions as F

    from tests.helpers import settings

    # A hot key left three quarters of the rows in one partition of eight.
    rows_ = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") % 4 < 3, 0).otherwise(F.col("id")).alias("k"))
    skewed = rows_.repartition(8, "k").drop("k")
    sizes = {}
    with settings(spark, adaptive__advisoryPartitionSizeInBytes="4m"):
        for even in (False, True):
            name = f"even_{even}_{uuid.uuid4().hex[:6]}".lower()
            spark.sql(f"CREATE TABLE {name} (id BIGINT, v STRING) USING parquet LOCATION '{tmp_path}/{name}'")
            kl.append(skewed, name, even_files=even)
            assert spark.table(name).count() == 400_000
            sizes[even] = sorted(f.stat().st_size for f in Path(f"{tmp_path}/{name}").glob("*.parquet"))
    median = {k: v[len(v) // 2] for k, v in sizes.items()}
    assert sizes[False][-1] > 5 * median[False] and sizes[True][-1] < 2 * median[True]
