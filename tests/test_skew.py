"""Hot keys: found, kept apart, and nothing lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import keyloom as kl
from tests.helpers import rows

N = 20_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows ask for one key, a tenth have none, the rest are spread."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .when(F.col("id") % 10 == 2, "")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    )
    return spark.range(0, N, 1, 8).select("id", key.alias("k")).checkpoint()


def test_find_hot_keys(spark, skewed):
    assert kl.find_hot_keys(skewed, "k", 0.01) == ["hot"]
    assert kl.find_hot_keys(skewed, "k", 0.9) == []
    assert kl.find_hot_keys(skewed.where("k is null"), "k") == []
    assert kl.find_hot_keys(skewed.where("id < 0"), "k") == []
    with pytest.raises(ValueError, match="share"):
        kl.find_hot_keys(skewed, "k", 0)


def test_keyless_share(skewed):
    assert kl.key_shares(skewed, "k").keyless == skewed.where("k is null or k = ''").count() / N
    assert kl.key_shares(skewed.where("k is null"), "k").keyless == 1
    assert kl.key_shares(skewed.where("k = 'hot'"), "k").keyless == 0


def test_every_key_at_or_over_the_share_is_found(spark):
    # 50 keys with 1% each, the other half spread thin.
    df = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("h"), (F.col("id") / 2).cast("int") % 50))
        .otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("k")
    )
    assert kl.find_hot_keys(df, "k", 0.009) == sorted(f"h{i}" for i in range(50))


def test_cold_and_free_are_a_partition_of_the_table(skewed):
    cold, free = kl.split_by_key(skewed, "k", ["hot"])
    assert rows(cold.unionByName(free)) == rows(skewed)
    assert {r.k for r in free.select("k").distinct().collect()} == {None, "", "hot"}
    assert cold.where("k is null or k in ('', 'hot')").count() == 0


def test_repartition_places_keys_and_spreads_the_rest(skewed):
    parts = 6
    placed = kl.repartition_by_key(skewed, "k", parts, ["hot"]).withColumn("p", F.spark_partition_id())
    assert placed.count() == N
    per_key = placed.where("k is not null and k not in ('', 'hot')").groupBy("k").agg(F.countDistinct("p").alias("n"))
    assert per_key.where("n > 1").count() == 0
    sizes = [r["count"] for r in placed.where("k = 'hot' or k = '' or k is null").groupBy("p").count().collect()]
    assert len(sizes) == parts
    assert max(sizes) < 1.2 * min(sizes)
    assert placed.rdd.getNumPartitions() == parts


def test_no_task_of_a_split_lookup_gets_the_hot_key(spark, skewed):
    dim = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("rowkey"), F.col("id").cast("string").alias("name"))
    dim = dim.unionByName(spark.range(1).select(F.lit("hot").alias("rowkey"), F.lit("H").alias("name")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = {}
        for label, options in {"plain": {}, "split": {"hot_share": 0.01}}.items():
            out = kl.lookup_enrich(skewed, dim, "k", ["name"], **options)
            assert out.count() == N
            assert out.where("name = 'H'").count() == skewed.where("k = 'hot'").count()
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            tasks = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            sizes[label] = tasks
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sizes["plain"] > N / 3
    assert sizes["split"] < N / 6
