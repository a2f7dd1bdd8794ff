"""Phrases against counting in plain Python, and the automata on random paths."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyloom.llm import collocations, count_automata
from keyloom.llm.common import table
from keyloom.llm.queries import QUERIES
from tests.helpers import rows

DATA = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, least=10, top=2000):
    """The rows for ``docs`` (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = {p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * counts[p[i : i + 2]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_query_against_plain_python(spark):
    docs = [tuple(r) for r in table(spark, DATA, "documents").select("lang", "text").collect()]
    got = QUERIES["op11_collocations"](spark, DATA)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows(got) == by_hand(docs) and len(by_hand(docs)) > 1000


def test_many_shards_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_SHARD", 5_000)
    monkeypatch.setattr(collocations, "_RANGE", 20_000)
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("lang", "text").collect()]
    docs += [("en", "one hot phrase here. " * 20_000), ("en", "hot " * 50_000)]
    df = spark.createDataFrame(docs, "lang STRING, text STRING").repartition(5)
    assert rows(collocations.collocations(df)) == by_hand(docs)


def test_odd_tables(spark):
    docs = [
        (None, None, 1),
        (None, "", 1),
        ("und", "A b c. " * 9, 1),
        (None, "a B c", 1),
        ("", "x\x01 y x y;x y\x0bx y" * 6, 2),
        ("tab\there\n", "\tq\tr  s q r s\r\n" * 12, 2),
        ("tab\there\n", "q \xa0 r   É é É é " * 11, 2),
        ("long", "w" * 3_000_000 + " v", 2),
        ("long", "aa bb cc " * 200_000, 2),
        ("ties", "b a. a b. b c. c b. " * 10, 3),
    ] * 2
    df = spark.createDataFrame(docs, "lang STRING, text STRING, `n.words` INT").withColumnsRenamed({"n.words": "words"})
    assert rows(collocations.collocations(df)) == by_hand([d[:2] for d in docs])
    assert rows(collocations.collocations(df, top=3)) == by_hand([d[:2] for d in docs], top=3)
    assert rows(collocations.collocations(df.limit(0))) == []
    assert rows(collocations.collocations(df.where("lang is null"))) == []


def test_products_over_64_bits(spark):
    assert 1_000_000 * (10**9) ** 2 > 1 << 64
    symbols = [b"en", b"x", b"y"]
    pair = count_automata.build(np.array([[0, 1, 2]]), np.array([10**9]), symbols)
    parts = count_automata.build(np.array([[0, 1], [0, 2]]), np.array([10**9 + 7, 3 * 10**9]), symbols)
    told = collocations._table([(parts.to_bytes(),)], [("automaton", collocations.pa.binary())])
    asked = collocations._table([(pair.to_bytes(),)], [("automaton", collocations.pa.binary())])
    (row,) = collocations._scored(told, asked).to_pylist()
    assert row["score"] == 1_000_000 * 10**18 // ((10**9 + 7) * 3 * 10**9)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 4), st.data())
def test_transducers_hold_what_was_put_in(depth, data):
    path = st.tuples(*[st.sampled_from([b"a", b"b", b"c", b"d", b""])] * depth)
    shards = data.draw(st.lists(st.dictionaries(path, st.integers(1, 5), min_size=1), min_size=1, max_size=4))
    made = []
    for shard in shards:
        symbols = sorted({s for p in shard for s in p})
        ordered = sorted(shard)
        paths = np.array([[symbols.index(s) for s in p] for p in ordered])
        one = count_automata.build(paths, np.array([shard[p] for p in ordered]), symbols)
        made.append(count_automata.CountTransducer.from_bytes(one.to_bytes()))
        found, counts = made[-1].paths()
        assert {tuple(made[-1].symbols[i] for i in p): c for p, c in zip(found.tolist(), counts.tolist(), strict=True)} == shard
        assert [tuple(made[-1].symbols[i] for i in p) for p in found.tolist()] == ordered
        for s in range(len(made[-1].start) - 2):  # all states but the first are pushed, and no two are equal
            assert made[-1].output[made[-1].start[s] : made[-1].start[s + 1]].min() == 0
    total = Counter()
    for shard in shards:
        total.update(shard)
    paths, counts, symbols = count_automata.union(made)
    assert {tuple(symbols[i] for i in p): c for p, c in zip(paths.tolist(), counts.tolist(), strict=True)} == dict(total)
    whole = count_automata.build(paths, counts, symbols)
    for shard, one in zip(shards, made, strict=True):
        assert whole.compose(one).tolist() == [total[p] for p in sorted(shard)]
        assert made[0].compose(one).tolist() == [shards[0].get(p, -1) for p in sorted(shard)]


def test_equal_endings_are_one_state():
    symbols = [b"a", b"b", b"x", b"y"]
    paths = np.array([[0, 2], [0, 3], [1, 2], [1, 3]])
    same = count_automata.build(paths, np.array([1, 3, 5, 7]), symbols)  # both states: x, and y two more
    other = count_automata.build(paths, np.array([1, 3, 5, 9]), symbols)
    assert len(same.start) - 1 == 2 and len(other.start) - 1 == 3


@pytest.mark.parametrize("size", [1, 7, 64])
def test_slices_keep_words_whole(monkeypatch, size):
    text = "One, two  three.four\tfive " * 9 + "x" * 100
    whole = [w for part in collocations.pieces_of(text) for w in part]
    monkeypatch.setattr(collocations, "_SLICE", size)
    assert [w for part in collocations.pieces_of(text) for w in part] == whole
