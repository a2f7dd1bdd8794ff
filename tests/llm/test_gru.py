"""The recurrent model's gradients, its probabilities, and the query against plain Python."""

from __future__ import annotations

import cProfile
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyloom.llm import gru_model, gru_scoring
from keyloom.llm.common import table
from keyloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def base_by_hand(docs):
    """doc_id: held_out, n_tokens, n_known, train_tokens, base_score."""
    held = {d: d is None or zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    c = Counter(t for d, text in docs if not held[d] for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return sorted((str(d), held[d], len(ts), sum(c[t] > 0 for t in ts), n, round(sum(log10((c[t] + 1) / (n + v + 1)) for t in ts), 6)) for d, text in docs for ts in [tokens(text)])


def small_model(seed=3):
    rng = np.random.default_rng(seed)
    model = gru_model.Gru.fresh(np.arange(1.0, 131.0), np.array([5.0, 9.0, 1.0]))
    for k, v in model.p.items():
        model.p[k] = (v + rng.normal(0, 0.3, v.shape)).astype(np.float32)
    return model


def test_probabilities_add_up_to_one():
    model = small_model()
    states = np.random.default_rng(0).uniform(-1, 1, (4, gru_model.HIDDEN)).astype(np.float32)
    every = np.arange(133)
    for state in states:
        found = model.log_probability(np.repeat(state[None], 133, axis=0), every)
        assert np.exp(found.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    model = small_model()
    given, wanted = rng.integers(0, 133, (5, 4)), rng.integers(0, 133, (5, 4))
    reset, live = rng.random((5, 4)) < 0.2, rng.random((5, 4)) < 0.9
    h = rng.uniform(-1, 1, (4, gru_model.HIDDEN)).astype(np.float32)
    slopes, _, _ = model.slopes(given, wanted, reset, live, h)

    def loss():
        states, _ = model.read(given, reset, h)
        return -(model.log_probability(states.reshape(20, -1), wanted.ravel()).astype(float) * live.ravel()).sum()

    for name, p in model.p.items():
        dense = slopes[name]
        if isinstance(dense, tuple):
            dense = np.zeros_like(p)
            dense[slopes[name][0]] = slopes[name][1]
        for i in np.argsort(-np.abs(dense).ravel())[[0, 1, 2, 5]]:
            at, step = np.unravel_index(i, p.shape), 1e-2
            held = p[at]
            p[at] = held + step
            up = loss()
            p[at] = held - step
            down = loss()
            p[at] = held
            assert dense[at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=0.02), name


def test_classes_share_one_softmax():
    rng = np.random.default_rng(4)
    model = gru_model.Gru.fresh(np.arange(1.0, 1025.0), np.ones(32))
    states = rng.uniform(-1, 1, (4096, gru_model.HIDDEN)).astype(np.float32)
    profile = cProfile.Profile()
    profile.runcall(model.log_probability, states, rng.integers(0, 1056, 4096))
    sums = [s.callcount for s in profile.getstats() if "'sum' of 'numpy.ndarray'" in str(s.code)]
    assert sum(sums) <= 4  # not one for each of the 32 classes


def test_state_is_carried_through_a_document_and_not_into_the_next():
    model = small_model()
    rng = np.random.default_rng(2)
    docs = [np.r_[rng.integers(1, 133, n - 1), 0].astype(np.int16) for n in (1, 3, 700, 16, 17, 2, 40, *[5] * 300)]
    got = dict(gru_model.score(model, iter(docs), 0))
    for i, ids in enumerate(docs):
        states, _ = model.read(np.r_[0, ids[:-1]][:, None], np.zeros((len(ids), 1), bool), np.zeros((1, gru_model.HIDDEN), np.float32))
        whole = model.log_probability(states[:, 0], ids.astype(np.int64)).astype(float).sum() / np.log(10)
        assert got[i] == pytest.approx(whole, rel=1e-4)


def test_words_of_a_batch_are_split_at_once(monkeypatch):
    texts = ["", None, " ", "a", " a\x0bB  \x1cc\n", "Ä É x\xa0y", "\x85   z\u2003", "\t\r\n", "x" * 50, "İ SS ẞ"]
    wanted = [[(t or "").encode() for t in tokens(text)] for text in texts]
    words, edges = gru_scoring.words_of(pa.array(["left out", *texts])[1:])
    assert [words[a:b].to_pylist() for a, b in zip(edges, edges[1:], strict=False)] == wanted
    assert gru_scoring.tails_of(words).tolist() == [gru_scoring.tail_of(w) for ws in wanted for w in ws]
    with pytest.raises(pa.ArrowInvalid, match="UTF8"):
        gru_scoring.words_of(pa.StringArray.from_buffers(1, pa.array([0, 3], pa.int32()).buffers()[1], pa.py_buffer(b"a \xff")))
    monkeypatch.setattr(gru_scoring, "_PIECE", 8)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["row", "text"])
    pieces = list(gru_scoring._pieces(batch, 1))
    assert len(pieces) > 2 and pa.Table.from_batches(pieces).to_pydict() == batch.to_pydict()
    assert list(gru_scoring._pieces(batch[:0], 1)) == []


def test_query_against_plain_python(spark):
    docs = [tuple(r) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op12_gru_scoring"](spark, DATA).collect()
    assert list(got[0].asDict()) == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == base_by_hand(docs)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_same_answer_however_the_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(gru_scoring, "NEAR", 50)  # most words are far, so the join tells their counts
    monkeypatch.setattr(gru_scoring, "HEAD", 20)
    monkeypatch.setattr(gru_scoring, "_FAN_IN", 2)
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    found = []
    for n in (1, 7):
        df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(n)
        got = gru_scoring.log_probabilities(df, shard_tokens=3_000).collect()
        assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == base_by_hand(docs)
        found.append({r["doc_id"]: r["score"] for r in got})
    assert found[0].keys() == found[1].keys()
    assert all(found[1][k] == pytest.approx(v, rel=1e-4) for k, v in found[0].items())


def test_odd_tables(spark):
    docs = [(None, "a b"), (1, None), (1, None), (2, ""), (3, "Ä ä a\x0bb\x1cc"), (4, "a " * 30_000), (5, "x" * 500_000), (6, "a b"), (6, "a b")]
    df = spark.createDataFrame([(*d, 1, "z", 0.5) for d in docs], "doc_id BIGINT, text STRING, score INT, word STRING, `n.tokens` DOUBLE")
    got = gru_scoring.log_probabilities(df).collect()
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == base_by_hand(docs)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 6]
    assert len(same) == 2 and same[0] == pytest.approx(same[1], rel=1e-5)
    assert gru_scoring.log_probabilities(df.limit(0)).collect() == []
    alone = gru_scoring.log_probabilities(df.where("doc_id is null")).collect()  # nothing to learn from
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in alone] == [(0, 0, 0.0)] and np.isfinite(alone[0]["score"])
    whole = gru_scoring.log_probabilities(df, held_out=F.lit(False)).collect()
    assert {r["train_tokens"] for r in whole} == {sum(len(tokens(t)) for _, t in docs)}
