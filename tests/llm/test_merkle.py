"""The manifest against the same trees made in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from keyloom.llm import merkle
from keyloom.llm.common import table
from keyloom.llm.queries import QUERIES
from tests.helpers import rows

DATA = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n_chars, text):
    said = [None if v is None else str(v) for v in (doc, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in said))


def tree(leaves):
    """Root, and for each leaf its runs ``(others before, others after)``."""
    nodes, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for leaf_no, place in enumerate(at):
            run = runs[place // 16]
            paths[leaf_no].append((run[: place % 16], run[place % 16 + 1 :]))
            at[leaf_no] = place // 16
        nodes = [h(*r) for r in runs]
    return nodes[0], paths


def by_hand(docs, tampered):
    """The rows that a manifest of ``docs`` (doc_id, source, lang, n_chars, text) has."""
    sources = sorted({d[1] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((d for d in docs if d[1] == s), key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d))) for s in sources}
    trees = {s: tree([leaf(*d) for d in of[s]]) for s in sources}
    root, tops = tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops, strict=True):
        for d, own in zip(of[s], trees[s][1], strict=True):
            path = own + top
            now = leaf(*d[:4], d[4].translate(LOWER) if d[4] is not None and tampered(d[0]) else d[4])
            for before, after in path:
                now = h(*before, now, *after)
            out.append((d[0], leaf(*d), trees[s][0], root, h(*(x for b, a in path for x in (*b, *a))), now, now == root))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def fifth(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def test_query_against_plain_python(spark):
    docs = [tuple(r) for r in table(spark, DATA, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = QUERIES["op13_merkle_manifest"](spark, DATA)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows(got) == by_hand(docs, fifth)
    assert {r[6] for r in rows(got)} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 273, 289, 1200])
def test_rounds_of_the_exchange(spark, monkeypatch, n):
    """Partitions of one leaf, so that rounds, ghosts and last groups of every kind occur."""
    monkeypatch.setattr(merkle, "_OWN_LEVELS", 0)
    monkeypatch.setattr(merkle, "_LEAVES", 1)
    docs = [(i, "a" if i < n else "b", "en", i, f"Text {i}") for i in range(n + 5)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING")
    partitions, climbed = merkle._trees(
        df.select(F.col("doc_id").alias("key"), F.col("source").alias("source_key"), merkle.row_digest({c: F.col(c) for c in df.columns}).alias("leaf")), "source_key", ["key"], ["key", "leaf"]
    )
    root, paths = tree([leaf(*d) for d in docs[:n]])
    got = {r["id"]: r for r in climbed.where("source_key = 'a'").collect()}
    assert len(got) == n == partitions.where("source_key = 'a'").count()
    for i, path in enumerate(paths):
        assert got[i]["node"] == root
        assert [(s["at"], s["siblings"]) for s in got[i]["path"]] == [(len(b), "".join(b + a)) for b, a in path]


def test_more_than_one_partition_of_a_source(spark):
    docs = [(i, "hot" if i % 3 else f"s{i % 7}", "en", i, f"Text {i}") for i in range(8000)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING")
    lowered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lower("text")).otherwise(F.col("text"))
    assert rows(merkle.manifest(df, changed={"text": lowered})) == by_hand(docs, fifth)


def test_odd_tables(spark):
    schema = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, leaf STRING, key INT, idx INT, `a.b` INT"
    docs = [
        (None, None, None, None, None),
        (None, "", "en", 0, ""),
        (3, "", "en", 1, "Ä"),
        (3, "", "en", 1, "Ä"),
        (3, "", "en", 2, "other"),
        (4, None, "fr", 3, "X" * 300_000),
        (5, "\U0001f600", "fr", 3, "é"),
        (6, "é", "fr", 3, "é"),
    ]
    df = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], schema)
    got = merkle.manifest(df)
    assert rows(got) == by_hand(docs, lambda _: False)
    assert all(r[6] for r in rows(got))
    assert rows(merkle.manifest(df.limit(0))) == []
    assert rows(merkle.manifest(df.where("doc_id = 6"))) == by_hand(docs[-1:], lambda _: False)
