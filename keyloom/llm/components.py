"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import cut


def _toward_smaller(edges: DataFrame) -> DataFrame:
    """Each edge once, as ``a > b``."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the larger (``large``) or else the smaller neighbours of each node to the smallest of them and itself."""
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        pairs = pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    # Written, not reused as an aggregate: adaptive execution splits a node with very many links only between two plain shuffles.
    least = cut(pairs.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least")))
    moved = pairs.join(least, "node")
    if large:
        return _toward_smaller(moved.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b")))
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return _toward_smaller(moved.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(own))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for each node that has a link.

    Each step is written to the shared folder. Their number grows with the logarithm of
    the nodes; nothing but a count and a checksum comes to the driver. Minima are
    combined before they are shuffled, so a node with very many links sends few rows, and its links are
    split over tasks when they meet the minimum.
    """
    edges = cut(_toward_smaller(links.select(F.col(a).alias("a"), F.col(b).alias("b"))))

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edges)
    while True:
        edges = cut(_star(_star(edges, large=True), large=False))
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
