"""Exact top-k by inner product in three phases with a uniform threshold.

Vectors are split into slices of their components; a slice's part of the inner product
is a local score. Phase 1 gathers, per query and slice, the k best local
scores of each task and the totals of those rows; the k-th best total is a
safe cutoff. A row whose total reaches it has at least one local score, counted from the
lowest one in its slice, of an equal share of the cutoff. Phase 2 sends these uniform
thresholds to all tasks, which collect every row that reaches one. Phase 3
computes the totals of the collected rows exactly and ranks them.

Queries are taken in blocks of a fixed number of rows, so what is sent to
the tasks is bounded whatever the number of queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut, shared_folder

SCALE = 256
SLICES = 2
BLOCK = 4096  # queries, about, whose vectors and thresholds are sent to the tasks at once
_ROWS = 1024  # candidate rows scored together
_HELD = 1 << 18  # collected rows a task holds before it drops all but the best of each query
_EXACT = 2**53
_LONG = np.iinfo(np.int64)


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and integer components ``v`` of the rows that take part: nothing null, all components finite."""
    x = col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(col(key).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        col(key).cast("bigint").alias("key"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v")
    )


def _largest(vectors: list[np.ndarray]) -> int:
    return max((max(abs(int(v.min())), abs(int(v.max()))) for v in vectors if len(v)), default=0)


class QueryBlock:
    """Some queries; gives the local scores of their slices."""

    def __init__(self, ids: list[int], vectors: list[list[int]], slices: int):
        self.ids, self.vectors, self.slices = np.array(ids, np.int64), [np.array(v, np.int64) for v in vectors], slices
        self.width, self.largest = max(map(len, self.vectors)), _largest(self.vectors)

    def local_scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """By slice, query and row; components that the shorter vector lacks count as zero.

        Floats while all sums are exact in them, else Python integers.
        """
        exact = self.largest * _largest(rows) * max(self.width, 1) < _EXACT
        q, x = (np.zeros((len(v), self.width), np.float64 if exact else object) for v in (self.vectors, rows))
        for matrix, vectors in ((q, self.vectors), (x, rows)):
            for i, v in enumerate(vectors):
                v = v[: self.width]
                matrix[i, : len(v)] = v if exact else v.astype(object)
        cuts = np.linspace(0, self.width, self.slices + 1).astype(int)
        return np.stack([q[:, a:b].dot(x[:, a:b].T) for a, b in zip(cuts, cuts[1:], strict=False)])


def _scored(batches: Iterator[pa.RecordBatch], queries: QueryBlock) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of some candidates, their local scores, and which of them are a query's own row."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            ends = np.cumsum(part.column(1).value_lengths().to_numpy(zero_copy_only=False))
            rows = np.split(part.column(1).flatten().to_numpy(zero_copy_only=False), ends[:-1])
            ids = part.column(0).to_numpy()
            yield ids, queries.local_scores(rows), queries.ids[:, None] == ids[None, :]


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; beyond their range the nearest long."""
    return np.clip(scores, _LONG.min, _LONG.max).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


def _best(k: int, group: np.ndarray, score: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Positions of the ``k`` highest scores of each group, ties to the smaller key."""
    order = np.lexsort((key, ~score, group))  # ~ reverses the order of longs without overflow
    ordered = group[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
    return order[rank < k]


def _gather(block, k: int):
    def phase_1(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: QueryBlock = block.value
        n, m = len(queries.ids), queries.slices
        lowest, held = None, [np.zeros(0, np.int64)] * 4  # list (query and slice), key, local score, total
        for ids, local, own in _scored(batches, queries):
            low = local.min(axis=2)
            lowest = low if lowest is None else np.minimum(lowest, low)
            total, most = _as_long(local.sum(axis=0)), min(k + 1, len(ids))  # one more, as the query itself may be among them
            for s in range(m):
                score = _as_long(local[s])
                top = np.argpartition(score, len(ids) - most, axis=1)[:, -most:]
                q = np.repeat(np.arange(n), most)
                new = [q * m + s, ids[top].ravel(), np.take_along_axis(score, top, 1).ravel(), np.take_along_axis(total, top, 1).ravel()]
                other = ~np.take_along_axis(own, top, 1).ravel()
                held = [np.concatenate((h, x[other])) for h, x in zip(held, new, strict=True)]
            if len(held[0]) > max(_HELD, 4 * n * m * k):
                held = [h[at] for at in [_best(k, held[0], held[2], held[1])] for h in held]
        if lowest is not None:
            at = _best(k, held[0], held[2], held[1])
            lists = np.arange(n * m)
            columns = [np.concatenate(x) for x in ((held[0][at], lists), (held[1][at], np.zeros(n * m, np.int64)), (held[3][at], _as_long(lowest.T.ravel())))]
            is_low = np.concatenate((np.zeros(len(at), bool), np.ones(n * m, bool)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, is_low)], ["list", "key", "score", "is_low"])

    return phase_1


def _thresholds(gathered: DataFrame, n: int, m: int, k: int) -> np.ndarray:
    """Uniform threshold of each query and slice: the safe cutoff's equal share above the slice's lowest score."""
    query = F.expr(f"list div {m}").alias("query")
    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    totals = gathered.where("not is_low").select(query, "key", "score").distinct()
    cutoff, low = np.full(n, -np.inf), np.zeros(n * m)
    for r in totals.withColumn("rank", ranked).where(F.col("rank") == k).collect():  # one row per query of the block
        cutoff[r["query"]] = r["score"] if r["score"] > _LONG.min else -np.inf
    for r in gathered.where("is_low").groupBy("list").agg(F.min("score").alias("low")).collect():
        low[r["list"]] = r["low"]
    low = low.reshape(n, m)
    share = low + (cutoff - low.sum(axis=1))[:, None] / m
    return np.floor(share - 1e-9 * np.abs(share)) if np.isfinite(share).all() else np.where(np.isfinite(share), np.floor(share - 1e-9 * np.abs(share)), -np.inf)


def _collect(block, thresholds, k: int):
    def phases_2_and_3(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = block.value, thresholds.value
        held = [np.zeros(0, np.int64)] * 3  # query, score, key

        def best():
            at = _best(k, *held)
            return [h[at] for h in held]

        for ids, local, own in _scored(batches, queries):
            q, r = np.nonzero((local >= least.T[:, :, None]).any(axis=0) & ~own)
            held = [np.concatenate((h, x)) for h, x in zip(held, (q, _as_long(local[:, q, r].sum(axis=0)), ids[r]), strict=True)]
            if len(held[0]) > max(_HELD, 4 * len(queries.ids) * k):
                held = best()
        q, score, key = best()
        yield pa.RecordBatch.from_arrays([pa.array(queries.ids[q]), pa.array(key), pa.array(score)], ["query_id", "key", "score"])

    return phases_2_and_3


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``key``, ``score``: the ``k`` best rows for each row whose ``key`` ``every`` divides.

    Scores are inner products of components floor(256 x), exact; beyond the range of
    longs they are the nearest long. Ties go to the smaller key. A query's
    candidates are all rows with another key, all of them if there are fewer than ``k``. Rows
    with a null key, a null vector, or a null or non-finite component take no part; vectors of
    different lengths are compared as if filled up with zeros. Repeated candidates are
    ranked each; of repeated queries one is asked. Extra columns play no part.

    Each block of queries reads the table twice; more blocks than one append their results to a new folder
    ``top-k-*`` in the shared one, which is read once and stays there. Tasks pass on at most ``k`` rows per
    query and slice, so shuffles grow with tasks and queries, not with pairs.
    """
    spark = df.sparkSession
    rows = integer_vectors(df, key, vector)
    queries = cut(rows.where(F.col("key") % every == 0).groupBy("key").agg(F.min("v").alias("v")))
    n_blocks = max(1, -(-queries.count() // block))
    folder, schema = f"{shared_folder(spark)}/top-k-{uuid.uuid4().hex}", "query_id bigint, rank int, key bigint, score bigint"
    results = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        asked = queries.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == b).orderBy("key").collect()  # about `block` rows
        if not asked:
            continue
        sent = spark.sparkContext.broadcast(QueryBlock([r["key"] for r in asked], [r["v"] for r in asked], slices))
        gathered = cut(rows.mapInArrow(_gather(sent, k), "list bigint, key bigint, score bigint, is_low boolean"))
        limits = spark.sparkContext.broadcast(_thresholds(gathered, len(asked), slices, k))
        found = rows.mapInArrow(_collect(sent, limits, k), "query_id bigint, key bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "key"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "key", "score")
        if n_blocks == 1:
            results = found
        else:
            found.write.mode("append").parquet(folder)
            results = spark.read.schema(schema).parquet(folder)
    return results.select("query_id", "rank", F.col("key").alias(key), "score")
