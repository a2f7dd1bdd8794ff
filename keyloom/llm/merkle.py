"""Merkle manifest of a dataset: one tree per source, one over the sources, and a proof for each row.

Rows are dealt to aligned partitions of 16**3 leaves. Each makes its own subtree;
then groups of sixteen partitions swap their roots round by round, partitions of a
group at ever larger strides, and each hashes the common ancestor for itself.
After the last round every partition holds the source's root and the upper part
of its rows' proofs, so nothing is sent down the tree again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut

FANOUT = 16
_OWN_LEVELS = 3  # levels that a partition hashes alone
_LEAVES = FANOUT**_OWN_LEVELS  # of a partition

_PATH = "array<struct<at: int, siblings: string>>"


def digest(parts: Sequence[str]) -> str:
    """A node of its children, digests being hex text."""
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def row_digest(columns: Mapping[str, Column]) -> Column:
    """Digest of a row: of each value its UTF-8 length, a colon and itself; a dash for a null."""
    texts = [c.cast("string") for c in columns.values()]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def levels(leaves: int) -> int:
    """Times that ``leaves`` nodes are hashed by sixteens until one is left."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // FANOUT), n + 1
    return n


def subtree(leaves: Sequence[str], height: int) -> list[list[str]]:
    """The nodes of ``height`` levels over aligned ``leaves``, from the leaves up."""
    found = [list(leaves)]
    for _ in range(height):
        below = found[-1]
        found.append([digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return found


def siblings(nodes: Sequence[Sequence[str]], leaf: int) -> list[tuple[int, str]]:
    """For each level under the top one: position in the run, and the other nodes of the run."""
    path = []
    for level in nodes[:-1]:
        start = leaf // FANOUT * FANOUT
        run = level[start : start + FANOUT]
        path.append((leaf - start, "".join(run[: leaf - start]) + "".join(run[leaf - start + 1 :])))
        leaf //= FANOUT
    return path


def folded(leaf: str, path: Sequence[tuple[int, str]]) -> str:
    """The root that ``leaf`` and its siblings lead to."""
    for at, others in path:
        cut_at = at * len(leaf)
        leaf = digest((others[:cut_at], leaf, others[cut_at:]))
    return leaf


def _numbered(items: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``items`` with ``idx``, the row's number within its group from 0, and ``n``, the rows of the group.

    A range sort deals a group of any size over many tasks; equal rows are told apart by
    where they were read. Counts per task and group give the offsets.
    """
    tie = items.withColumn("__tie", F.monotonically_increasing_id())
    keys = [group, *order, "__tie"]
    ranged = tie.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    at = ranged.columns.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            counts = []
            for g in batch.column(at).to_pylist():
                n = n + 1 if g == last else 0
                last = g
                counts.append(n)
            columns = [*batch.columns, pa.array([part] * len(counts), pa.int32()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "local"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields), "part int, local bigint"])
    numbered = cut(ranged.mapInArrow(number, schema))
    counts = numbered.groupBy(group, "part").agg(F.count("*").alias("here"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group,
        "part",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"),
        F.sum("here").over(Window.partitionBy(group)).alias("n"),
    )
    return numbered.join(offsets, [group, "part"]).withColumn("idx", F.col("local") + F.col("offset")).drop("part", "local", "offset")


def _partitions(numbered: DataFrame, group: str, payload: Sequence[str]) -> DataFrame:
    """One row per aligned partition: ``group, id, n``, and its at most 4096 ``items`` in order."""
    found = numbered.groupBy(group, "n", F.floor(F.col("idx") / _LEAVES).alias("id"))
    return cut(found.agg(F.sort_array(F.collect_list(F.struct("idx", *payload))).alias("items")))


def _roots(partitions: DataFrame, group: str) -> DataFrame:
    """``group, id, blocks, node``: the root of each partition's own subtree."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            nodes = [subtree(leaves, min(_OWN_LEVELS, levels(n)))[-1][0] for n, leaves in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.string())], ["g", "id", "node"])

    kind = partitions.schema[group].dataType.simpleString()
    own = partitions.select(F.col(group).alias("g"), "id", "n", F.col("items.leaf").alias("leaves"))
    nodes = own.mapInArrow(climb, f"g {kind}, id bigint, node string").withColumnRenamed("g", group)
    return nodes.join(partitions.select(group, "id", F.ceil(F.col("n") / _LEAVES).alias("blocks")), [group, "id"])


def _exchange(roots: DataFrame, group: str) -> DataFrame:
    """``group, id, node, path``: every partition with its group's root and the siblings on its way there.

    In a round a partition sends its node to the sixteen that share all digits of its
    number but one, and hashes what it gets. A partition that does not exist, but that
    a later round needs as a sender, is played by a ghost of that number; so nobody ever
    sends to more than sixteen, and ghosts are at most as many as partitions.
    """
    most = roots.agg(F.max("blocks")).first()[0] or 0
    state = roots.withColumn("path", F.expr(f"cast(array() as {_PATH})"))
    stride = 1
    while stride < most:
        wide = stride * FANOUT
        going = state.where(F.col("blocks") > stride)
        limit = F.when(F.col("blocks") <= wide, F.col("blocks")).otherwise(F.ceil(F.col("blocks") / wide) * wide)
        digit = F.floor(F.col("id") / stride) % FANOUT
        sent = going.select(
            group, "blocks", "id", "node", "path", limit.alias("limit"), digit.cast("int").alias("digit"), F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("d")
        ).withColumn("to", F.col("id") + (F.col("d") - F.col("digit")) * F.lit(stride).cast("bigint"))
        own = F.col("to") == F.col("id")
        got = (
            sent.where(F.col("to") < F.col("limit"))
            .groupBy(group, "blocks", "to")
            .agg(
                F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("got"),
                F.max(F.when(own, F.struct(F.lit(1).alias("one"), "path"))).alias("mine"),
            )
        )
        at = (F.floor(F.col("to") / stride) % FANOUT).cast("int")
        others = F.array_join(F.transform(F.filter("got", lambda x: x["digit"] != at), lambda x: x["node"]), "")
        step = F.array(F.struct(at.alias("at"), others.alias("siblings")))
        after = got.select(
            group,
            F.col("to").alias("id"),
            F.sha2(F.array_join(F.col("got.node"), "").cast("binary"), 256).alias("node"),
            "blocks",
            F.concat(F.coalesce(F.col("mine.path"), F.expr(f"cast(array() as {_PATH})")), step).alias("path"),
        )
        state = state.where(F.col("blocks") <= stride).unionByName(after)
        stride = wide
    return state.select(group, "id", "node", "path")


def _trees(items: DataFrame, group: str, order: Sequence[str], payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The partitions of every group's leaves, and what each holds after the exchange."""
    partitions = _partitions(_numbered(items, group, order), group, payload)
    return partitions, cut(_exchange(_roots(partitions, group), group))


def _source_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition of subroots: each source with the whole way from its subroot to the root."""
    for batch in batches:
        keys, roots, paths = [], [], []
        for row in batch.to_pylist():
            nodes = subtree([i["leaf"] for i in row["items"]], min(_OWN_LEVELS, levels(row["n"])))
            for i, item in enumerate(row["items"]):
                keys.append(item["source_key"])
                roots.append(row["node"])
                paths.append([*({"at": at, "siblings": s} for at, s in siblings(nodes, i)), *row["path"]])
        kind = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(roots, pa.string()), pa.array(paths, kind)], ["source_key", "root", "top"])


def manifest(df: DataFrame, key: str = "doc_id", source: str = "source", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), changed: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``df``: ``key``, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``columns``. The leaves of a source ascend by ``key``, and every
    sixteen nodes in a row are hashed into one until one is left; the sources' subroots,
    ordered by source, likewise. ``proof_sha256`` is the digest of all siblings from the leaf
    to the root. ``folded_root`` is made from the row's siblings and the leaf it would have
    with ``changed`` in place of those columns; ``verified`` tells whether it is the root.

    Nulls count in any column and come first in order; a null source is a source. Rows
    that are equal each have a leaf, in no particular order. Very long texts are hashed
    whole, in the scan. Other columns of ``df`` play no part, whatever their names. An empty table
    gives no rows. Texts are neither shuffled nor sent to Python; rows go
    through one range sort and one shuffle to their partition. All steps that a later one reads twice
    are written to the shared folder.
    """
    before = {c: col(c) for c in columns}
    after = {**before, **(changed or {})}
    rows = df.select(
        col(key).alias("key"),
        F.coalesce(F.concat(F.lit("+"), col(source).cast("string")), F.lit("")).alias("source_key"),  # a null is first, and no key of its own kind
        row_digest(before).alias("leaf"),
        (row_digest(after) if changed else F.lit(None).cast("string")).alias("changed"),
    )
    key_type = rows.schema["key"].dataType.simpleString()
    partitions, climbed = _trees(rows, "source_key", ["key", "leaf"], ["key", "leaf", "changed"])
    subroots = climbed.where("id = 0").select(F.lit(0).alias("all"), "source_key", F.col("node").alias("leaf"))
    held, top = _trees(subroots, "all", ["source_key"], ["source_key", "leaf"])
    ways = held.join(top, ["all", "id"]).select("n", "items", "node", "path").mapInArrow(_source_paths, f"source_key string, root string, top {_PATH}")
    upper = climbed.join(ways, "source_key").select("source_key", "id", F.col("node").alias("subroot"), "root", F.concat("path", "top").alias("path"))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("items").type.value_type.field("key").type
            for row in batch.to_pylist():
                nodes = subtree([i["leaf"] for i in row["items"]], min(_OWN_LEVELS, levels(row["n"])))
                rest = [(step["at"], step["siblings"]) for step in row["path"]]
                out = []
                for i, item in enumerate(row["items"]):
                    path = [*siblings(nodes, i), *rest]
                    proof = digest([others for _, others in path])
                    out.append((item["key"], item["leaf"], row["subroot"], row["root"], proof, folded(item["changed"] or item["leaf"], path)))
                keys, *texts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(t, pa.string()) for t in texts)], ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    schema = f"key {key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    proved = partitions.join(upper, ["source_key", "id"]).select("n", "items", "subroot", "root", "path").mapInArrow(prove, schema)
    return proved.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("key", key)
