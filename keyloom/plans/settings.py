"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and, with the threshold set,
# hashes a side whose shuffled partitions all turn out small, which saves
# sorting the large side. Spark leaves the threshold at 0, which is off.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def apply_settings(spark: SparkSession) -> None:
    """Set what neither the submission nor the session has set."""
    given = spark.sparkContext.getConf()
    fresh = spark.newSession()  # has what was submitted, and Spark's defaults
    for name, value in SETTINGS.items():
        if not given.contains(name) and spark.conf.get(name) == fresh.conf.get(name):
            spark.conf.set(name, value)
