"""Where queries that write tables may put them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a fresh folder under /tmp in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def new_table(spark: SparkSession, kind: str) -> tuple[str, str]:
    """Name and path of a table that no other run uses."""
    name = f"keyloom_{kind}_{uuid.uuid4().hex[:12]}"
    return name, f"{shared_dir(spark)}/{name}"
