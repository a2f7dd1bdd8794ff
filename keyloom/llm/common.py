"""What the operators of this subpackage share: tables, scratch, column names."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _find_package(spark: SparkSession) -> None:
    """Puts this package on the path of Python workers on this machine; on a cluster it comes by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def col(name: str):
    """A column by its whole name, dots included."""
    return F.col(quoted(name))


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one where a column of ``taken`` has it already."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a fresh one under /tmp in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there, so lost executors cost no lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def sampled(rows: DataFrame, total: int, most: int, key: str = "key") -> DataFrame:
    """All ``total`` rows, or about ``most`` of them, by the hash of ``key``."""
    if total <= most:
        return rows
    return rows.where(F.xxhash64(key) < F.lit(int(most / total * 2**64) - 2**63))
