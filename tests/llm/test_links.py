"""op2, op5, op9 and the pipeline, by brute force."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from keyloom.llm import components, quality_rules, queries, quotes, secret_scan, simhash_anchors, toxicity, uniform_threshold
from tests.helpers import plan_of, settings

DATA = "/root/testdata/sf0.01"


def roots_of(links, nodes):
    above = {n: n for n in nodes}

    def find(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        above[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, i) for i in range(2001, 2100)]
    links = [(a, b) for a, b in links if a != b]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == roots_of(links, {n for link in links for n in link})


def test_a_hot_node_is_split(spark):
    """All links of one node, dealt by that node, meet its minimum in more tasks than one."""
    edges = spark.range(1, 300_000, 1, 8).select(F.col("id").alias("a"), F.lit(0).cast("bigint").alias("b"))
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__skewJoin__skewedPartitionThresholdInBytes="64k", adaptive__advisoryPartitionSizeInBytes="64k"
    ):
        star = components._star(edges, large=False)
        assert star.count() == 299_999
        star = components._star(edges.unionByName(spark.range(1, 300_000).select(F.lit(300_001).cast("bigint").alias("a"), F.col("id").alias("b"))), large=False)
        star.collect()
        assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()


def test_golay_covers(spark):
    words = np.arange(1 << 14, dtype=np.int64) * 509 % (1 << 23)
    at, codeword, distance = simhash_anchors._near(words, 3)
    assert (at == np.arange(len(words))).all() and not simhash_anchors.syndrome(codeword).any() and distance.max() == 3


def test_links_are_all_found(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {f ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}) for f in base for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    got = [(r["a"], r["b"]) for r in simhash_anchors.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_near_duplicates_by_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items() if len(t) < 20_000}
    got = {r["doc_id"]: r for r in queries.op9_simhash_near_dedup(spark, DATA).collect()}
    assert set(got) == set(docs)
    fps |= {i: int(got[i]["fingerprint"], 16) for i in docs if i not in fps}
    assert all(int(got[i]["fingerprint"], 16) == f for i, f in fps.items())
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert {i: r["component_id"] for i, r in got.items()} == roots_of(links, docs)


def test_near_duplicates_edge_cases(spark):
    rows = [(5, None, "x"), (4, "", "x"), (None, "a b", "x"), (3, "A  B", "x"), (9, "long text " * 9000, "x"), (9, "long text " * 9000, "x"), (8, "long text " * 9000, "y"), (None, "alone here", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash_anchors.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 4), (4, 4), (None, 3), (3, 3), (9, 8), (9, 8), (8, 8), (None, None)], key=str)
    kept = simhash_anchors.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["fp"]) for r in kept.collect()), key=str) == sorted([(4, "x"), (3, "x"), (8, "y"), (None, "z")], key=str)
    twice = spark.createDataFrame([(1, "same row", "x")] * 5, "doc_id bigint, text string, fp string")
    assert simhash_anchors.keep_one(twice).count() == 1
    assert simhash_anchors.near_duplicates(df.limit(0)).count() == simhash_anchors.keep_one(df.limit(0)).count() == 0


def brute_top(rows, every, k):
    ints = {i: np.array([int(np.floor(256 * float(x))) for x in v], dtype=object) for i, v in rows}
    out = []
    for q in (i for i in ints if i % every == 0):
        n = {i: int(sum(a * b for a, b in zip(ints[q], v))) for i, v in ints.items() if i != q}
        out += [(q, r + 1, i, n[i]) for r, i in enumerate(sorted(n, key=lambda i: (-n[i], i))[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_by_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = sorted(tuple(r) for r in uniform_threshold.top_k(df, block=block).collect())
    assert got == brute_top(rows, 50, 5)


def test_many_blocks_are_one_scan(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(2)
    found = uniform_threshold.top_k(df, every=3, block=1)
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 3, 5)


def test_top_k_edge_cases(spark):
    rows = [(0, [1.0, -2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [3.0]), (6, []), (7, [1e12, 1e12])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in uniform_threshold.top_k(df).collect())
    assert [g[2] for g in got] == [5, 6, 7] and [g[3] for g in got[:2]] == [256 * 768, 0]
    assert uniform_threshold.top_k(df.limit(0)).count() == 0
    assert uniform_threshold.top_k(df.where("vec_id = 0")).count() == 0


def test_top_k_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLE["op5_exact_top_k"]).fetchall())
    assert sorted(tuple(r) for r in queries.op5_exact_top_k(spark, DATA).collect()) == want


def test_quotes_are_linked(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?"),
        (1, 1, "assistant", "Use sorted().\nIt returns a new list."),
        (1, 2, "user", "> > How do I sort a list?\n> Use sorted().\n> It returns a new list.\n\nAnd in place?"),
        (2, 0, "user", "Ann wrote:\n> and in   PLACE?\nCall its sort method."),
        (2, 1, "user", "> nobody said this\nHm."),
        (3, 0, "user", None),
        (3, 1, None, ""),
        (None, None, "user", "> Use sorted().\n> It returns a new list.\nOk."),
        (1, 1, "assistant", "Use sorted().\nIt returns a new list."),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("thread", F.lit("clash"))
    got = [tuple(r) for r in quotes.conversations(df).orderBy("thread", "position").select("thread", "position", "conv_id", "turn", "own_text", "reply_conv", "reply_turn", "n_quotes", "n_linked").collect()]
    assert len(got) == len(rows)
    by = {(g[2], g[3]): g for g in got}
    assert by[1, 2][4:] == ("And in place?", 1, 1, 2, 2)
    assert by[2, 0][4:] == ("Call its sort method.", 1, 2, 1, 1) and by[2, 0][0] == 1
    assert by[2, 1][4:] == ("Hm.", None, None, 1, 0) and by[3, 0][4] is None
    assert [g[2:4] for g in got if g[0] == 1] == [(1, 0), (1, 1), (1, 1), (1, 2), (2, 0)]
    for thread in {g[0] for g in got}:
        assert [g[1] for g in got if g[0] == thread] == list(range(sum(g[0] == thread for g in got)))
    assert quotes.conversations(df.limit(0)).count() == 0


def test_quoted_parts_are_linked(spark):
    rows = [
        (1, 0, "user", "First paragraph\nover two lines.\n\nSecond paragraph.\n\nThird one."),
        (1, 1, "user", "> Second paragraph.\n\nAgreed."),
        (2, 0, "user", "> First paragraph over\n> two lines.\nYes.\n> Third one.\n> Nobody said it.\nNo."),
        (3, 0, "user", "> No.\n> Second paragraph.\n> Third one.\nBoth."),
        (4, 0, "user", "> Yes.\n\n> also unknown\nOh."),
        (5, 0, "user", "> over two lines.\n> > Agreed.\nHm."),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.conversations(df).collect()}
    assert len(got) == len(rows)
    assert {k: (r["own_text"], r["reply_conv"], r["reply_turn"], r["n_quotes"], r["n_linked"], r["unlinked_quotes"]) for k, r in got.items() if k != (1, 0)} == {
        (1, 1): ("Agreed.", 1, 0, 1, 1, []),
        (2, 0): ("Yes.\nNo.", 1, 0, 2, 2, ["Nobody said it."]),
        (3, 0): ("Both.", 1, 0, 1, 1, []),
        (4, 0): ("Oh.", 2, 0, 2, 1, ["also unknown"]),
        (5, 0): ("Hm.", 1, 0, 2, 2, []),
    }
    assert {r["thread"] for r in got.values()} == {1}


def test_only_the_message_that_quotes_moves(spark):
    rows = [
        (1, 0, "user", "An original."),
        (None, None, "user", "> An original.\nQuotes it."),
        (None, None, "user", "Quotes nothing."),
        (None, None, "user", "Quotes nothing either."),
        (7, None, "user", "> An original.\nMoves."),
        (7, None, "user", "Stays without a turn."),
        (8, 1, "user", "> An original.\nMoves too."),
        (8, 1, "assistant", "Stays with a turn."),
        (9, 0, "user", "> Moves too.\nTwo up."),
        (9, 1, "user", "> Stays with a turn.\nOne up."),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    out = quotes.conversations(df).collect()
    got = {r["own_text"]: (r["thread"], r["depth"]) for r in out}
    assert len(out) == len(rows)
    assert got["Quotes nothing."] == got["Quotes nothing either."] == (None, 0)
    assert got["Moves."] == got["Moves too."] == (1, 1) and got["Two up."] == (1, 2)
    assert got["Stays without a turn."] == (7, 0) and got["Stays with a turn."] == (8, 0) and got["One up."] == (8, 1)
    assert got["Quotes it."] == (None, 0)


def test_own_lines_are_kept():
    text = "As I said:\nthe plan holds.\nShe writes:\n\n> old text\nmy answer\nHe said:"
    own, runs, passages = quotes.parse_quotes(text)
    assert own == "As I said:\nthe plan holds.\n\nmy answer\nHe said:"
    assert [lines for _, lines in passages] == [["old text"]]
    long = "On a day " + "and a night " * 100 + "Ann wrote:\n> old text"
    assert quotes.parse_quotes(long)[0] == ""
    assert quotes.parse_quotes("Ann wrote: yes\n> old text")[0] == "Ann wrote: yes"


def test_conversations_without_quotes_keep_their_order(spark):
    got = queries.op2_quotation_linking(spark, DATA)
    source = spark.read.parquet(f"{DATA}/conversations.parquet")
    want = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in source.collect())
    assert [tuple(r) for r in got.orderBy("thread", "position").select("conv_id", "turn", "role", "own_text").collect()] == want


def test_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    kept = {r["doc_id"]: r["text"] for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    judged = {i: quality_rules.judge(t) for i, t in kept.items()}
    kept = {i: j[-1] for i, j in judged.items() if j[6]}
    fps = {i: simhash_anchors.fingerprint(t) for i, t in kept.items()}
    roots = roots_of([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    kept = {i: t for i, t in kept.items() if roots[i] == i}

    out = corpus_pipeline.run(spark, DATA)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == set(kept)
    whole = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n != t").count() == 0

    stage = dict(corpus_pipeline.STAGES)["secret_scans"](spark, docs, DATA)
    assert stage.columns == docs.columns and secret_scan.find_secrets(stage).where(F.exists("secrets", lambda s: s["kind"] != "guess")).count() == 0


def test_stages_on_odd_tables(spark):
    rows = [(1, None, "en", None, None, "r"), (None, "", None, "s", 0, "r"), (2, "A text. " * 100, "en", "s", 800, "r"), (2, "A text. " * 100, "en", "s", 800, "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, rules string")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, DATA).columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, df, DATA).count()
