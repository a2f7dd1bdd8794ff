"""op3, op7, op8, op4: rules by brute force, classifiers on held-out labels, edge cases."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyloom.llm import co_training, common, quality_rules, queries, secret_scan, toxicity

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "x"), (5, "word " * 30_000), (5, "word " * 30_000), (7, "a\x0bb\x0cc\x1cd e")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1.5, "s") for i, t in ODD], "doc_id bigint, text string, rules double, secrets string")


def brute_spans(text):
    low = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in low.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secret_scan.BASE_KINDS[k], i, j) for i, k, j in sorted(found)]


def test_base_spans_by_brute_force(spark):
    rng = random.Random(5)
    parts = ["token", "TOKEN", "ſecret", "secret", "api_key", "apikey", "passwd", "=", ":", " ", '"', "'", "abc", "abcdef123", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "😀", "\n", "toKen"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(500)] + ["secret: token : abcdefgh", "token=token=abcdef12"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    for r in secret_scan.find_secrets(df).collect():
        assert [(s.kind, s.start, s.end) for s in r["secrets"] if s.kind != "guess"] == brute_spans(r["text"])


def test_guess_cost():
    cost = secret_scan.GuessCost().cost
    assert cost("password123") < 5 and cost("qwertyuiop") < 5 and cost("aaaaaaaaaa") < 4 and cost("20240101") < 6 and cost("abcabcabcabc") < 6
    assert cost("x7#kQ9!vLp2") > 12 and cost("9f14a7029c8514dfe98a") > 15
    values = ["passw0rd", "1998password", "zzzqwerty!", "kQ", ""]
    for value in values:  # the cheapest of all segmentations, by trying them all

        def least(i, value=value):
            if i == len(value):
                return 0.0
            own = [cost_of + least(j) for s, j, cost_of in spans if s == i]
            return min([secret_scan.GuessCost.character_cost(value[i]) + least(i + 1), *own])

        spans = list(secret_scan.GuessCost().spans(value))
        assert cost(value) == pytest.approx(least(0))


def test_guessed_values_and_redaction(spark):
    rows = [(1, "pwd: x7#kQ9!vLp2 end"), (2, "login is welcome"), (3, 'token = "9f14a7029c8514dfe98aba92" x'), (4, None), (5, "no secrets")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kinds = {r["doc_id"]: [(s.kind, s.start, s.end) for s in r["secrets"]] for r in secret_scan.find_secrets(df).collect()}
    assert kinds[1] == [("guess", 5, 16)] and kinds[2] == [] and kinds[4] == []
    assert [k for k, *_ in kinds[3]] == ["assign", "hex", "guess"]
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(df).collect()}
    assert clean[1] == "pwd: [SECRET] end" and clean[3] == '[SECRET]" x' and clean[4] is None and clean[5] == "no secrets"


@pytest.mark.parametrize(
    "name",
    ["aws_secret_access_key = ", "secret_key: ", "access_key=", "signing_key=", "encryption-key: ", "DB_PASSWORD_PROD=", "tokenId = ", "AUTH_2: ", "secretAccessKey => ",
     "pwd" + " " * 12 + "= ", "private_key" + "\t" * 9 + ":" + " " * 30, "secrets: ", "password_hash is  ", "login" + " " * 20 + "is "],
)
def test_names_of_secrets(name):
    text = f"x {name}x7#kQ9!vLp2 end"
    at = text.index("x7#")
    assert secret_scan.guess_spans(text, text.lower(), secret_scan.GuessCost(), secret_scan.MIN_COST) == [("guess", at, at + 11)]


def test_other_names_and_long_texts_of_names():
    costs = secret_scan.GuessCost()
    for text in ("Author: Shakespeare", "AUTHOR: Shakespeare", "secretary: Montgomery", "passenger = Featherstone", "tokenizer: sentencepiece"):
        assert secret_scan.guess_spans(text, text.lower(), costs, secret_scan.MIN_COST) == []
    for part in ("password", "pass_", "token ", "secret    ", "secret_key\n"):  # would not end if work were not linear
        text = part * 200_000 + " " * 1_000_000
        assert secret_scan.guess_spans(text, text.lower(), costs, secret_scan.MIN_COST) == []


CLEAN = [
    "The password: required for all users",
    "auth: disabled in this release",
    "token: sentencepiece model of the day",
    "login is unavailable today",
    "by compass: northwest wind",
]


def test_words_of_the_corpus_are_no_secrets(spark):
    prose = "it is required that users stay disabled until the sentence or piece is unavailable in the northwest " * 3
    secret = "password: Vq7RkzLwPmTx and token = zkqvwxjpfhbtgd"  # the second all letters, and in many copies
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([prose, None, "", *CLEAN, *[secret] * 40])], "doc_id bigint, text string")
    common = secret_scan.common_words(docs)
    assert "required" in common and "zkqvwxjpfhbtgd" not in common and common == secret_scan.common_words(docs.repartition(7))
    found = {r["text"]: [(s.kind, r["text"][s.start : s.end]) for s in r["secrets"]] for r in secret_scan.find_secrets(docs, common=common).collect() if r["text"]}
    assert [v for k, v in found[secret] if k == "guess"] == ["Vq7RkzLwPmTx", "zkqvwxjpfhbtgd"]
    assert not [s for t in CLEAN for s in found[t] if s[0] == "guess"]
    assert secret_scan.common_words(docs.limit(0)) == []


def test_planted_secrets_by_precision_and_recall(spark):
    """Random values are found, sentences of the corpus after the same names are not."""
    rng = random.Random(5)
    words = sorted({w for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(200).collect() for w in re.findall(r"[a-z]{6,12}", r["text"])})
    signs = string.ascii_letters + string.digits + "!#%&*+"
    rows = []
    for i in range(200):
        name = rng.choice(["pwd: ", "db_pass = ", "login is ", "auth_2=", "my credential: "])
        rows.append((i, True, f"a {name}{''.join(rng.choices(signs, k=12))} b"))
        rows.append((200 + i, False, f"a {name}{rng.choice(words)} b"))
    planted = spark.createDataFrame(rows, "doc_id bigint, secret boolean, text string")
    common = secret_scan.common_words(spark.read.parquet(f"{DATA}/documents.parquet"))
    told = secret_scan.find_secrets(planted, common=common).select("secret", (F.size("secrets") > 0).alias("found")).collect()
    hits = sum(r["found"] for r in told if r["secret"])
    wrong = sum(r["found"] for r in told if not r["secret"])
    assert hits / 200 > 0.97 and hits / (hits + wrong) > 0.9


def test_names_are_redacted(spark):
    df = spark.createDataFrame([("a\naws_secret_access_key = wJalrXUtnFEMI/K7MDENG/bPxRfi\nb",)], "text string")
    assert secret_scan.redact(df).first()[0] == "a\naws_secret_access_key = [SECRET]\nb"


def test_odd_texts(odd):
    assert secret_scan.find_secrets(odd).count() == len(ODD)
    got = {(r["doc_id"], r["text"]): r["r"] for r in quality_rules.clean_lines(odd, into="r").collect()}
    for i, t in ODD:
        r, words = got[i, t], re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
        assert r["kept"] is False
    empty = odd.limit(0)
    assert quality_rules.clean_lines(empty).count() == secret_scan.redact(empty).count() == 0


def test_quality_figures_by_brute_force(spark):
    for r in quality_rules.clean_lines(spark.read.parquet(f"{DATA}/documents.parquet")).collect():
        text, got = r["text"], r["rules"]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"], got["base_failed"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)
        kept = [x for x in text.split("\n") if not quality_rules.line_fault(x)]
        assert got["cleaned"] == "\n".join(kept)


def test_quality_rules_agree_with_labels(spark):
    kept = queries.op7_line_quality(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("not base_failed")
    assert kept.where("kept != (quality = 1)").count() == 0


@pytest.mark.parametrize(
    ("line", "fault"),
    [
        ("A whole sentence that ends well.", None),
        ("", None),
        ("Home | About | Contact", "navigation"),
        ("Licensed under the Apache License, Version 2.0.", "boilerplate"),
        ("a*** b*** c*** d*** e*** f.", "symbols"),
        ("THIS IS!! ALL!! VERY!! LOUD!! HERE!!", "shouting"),
        ("Just a heading", "punctuation"),
        ("))", None),
        ("यह एक पूरा वाक्य है।", None),
        ("هل هذه جملة كاملة؟", None),
        ("これは文です。", None),
        ("Nur eine Überschrift", "punctuation"),
        ("Tous droits réservés.", "boilerplate"),
        ("Datenschutz beachten.", "boilerplate"),
        ("Todos los derechos reservados.", "boilerplate"),
        ("Der Datenschutz ist ein Grundrecht, über das in jeder Sitzung des Rates lange gestritten wurde, bis alle müde waren.", None),
        ("Pour en savoir plus, il faut lire les vingt volumes que l'auteur a laissés à sa mort dans cette maison près du fleuve.", None),
    ],
)
def test_line_rules(line, fault):
    assert quality_rules.line_fault(line) == fault


@pytest.mark.parametrize("phrase", ["read more", "powered by", "share one", "share on", "click here", "privacy policy", "all rights reserved"])
def test_prose_may_hold_a_phrase(phrase):
    prose = " ".join(f"The {i}th of many sentences tells of place {i * 7} and what people do there." for i in range(60))
    text = f"{prose} They {phrase} there and go. {prose}"
    assert quality_rules.line_fault(text) is None
    *_, kept, failed, lost, cleaned = quality_rules.judge(" ".join(f"w{i} x{i * i}." for i in range(300)) + f" They {phrase} there.")
    assert (kept, failed, lost) == (True, 0, 0) and cleaned


def test_phrases_are_whole_words():
    assert quality_rules.line_fault("And is erer. Ereaes oftheshare onstor.") is None
    for line in ("Copyright ©2020 Example.", "copyright (c) Example.", "© Example. All rights reserved.", "Click here to read more about our privacy policy and our terms of use."):
        assert quality_rules.line_fault(line) == "boilerplate"


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    r = scored.agg(F.sum(F.expr("predicted * toxic")).alias("tp"), F.sum("predicted").alias("p"), F.sum("toxic").alias("t")).first()
    assert r["tp"] / r["p"] > 0.9 and r["tp"] / r["t"] > 0.75


def test_toxicity_model_does_not_depend_on_partitions(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    made = []
    for n in (4, 211):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            made.append(toxicity.train(docs.repartition(n), labels, sample=300, shards=3, rounds=2))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert made[0].at.tolist() == made[1].at.tolist() and made[0].weight.tolist() == made[1].weight.tolist() and made[0].bias == made[1].bias
    assert len(made[0].at) > 10


def test_samples_of_very_many_rows(spark):
    """The share of a sample is never rounded down to nothing."""
    rows = spark.range(100_000).withColumnRenamed("id", "key")
    assert common.sampled(rows, 100_000, 100_000).count() == 100_000
    assert 800 < common.sampled(rows, 10**11, 10**9).count() < 1200  # one in a hundred
    assert common.sampled(rows, 10**17, 12_000)._jdf is not None and int(12_000 / 10**17 * 2**64) > 2_000_000


def test_toxicity_edge_cases(spark, odd):
    labels = spark.createDataFrame([(2, 1), (5, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")
    model = toxicity.train(odd, labels)
    scores = [r["score"] for r in toxicity.score(odd, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    nothing = toxicity.train(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, nothing).collect()} == {0.5}
    assert toxicity.train(odd.limit(0), labels).bias == 0
    assert toxicity.held_out(None) and toxicity.held_out("x") in (True, False)


def test_co_training_on_held_out_labels(spark):
    scored = queries.op4_quality_co_training(spark, DATA)
    assert scored.count() == 1000
    held = scored.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert held.where("kept = (quality = 1)").count() > 0.95 * held.count()


def test_all_unlabelled_rows_are_learnt_from(spark, monkeypatch):
    fitted = []

    def fit(rows, features, penalty, real=co_training._fit):
        fitted.append((rows.count(), features))
        return real(rows, features, penalty)

    monkeypatch.setattr(co_training, "_fit", fit)
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 2 = 0, 'Some good text here.', 'BAD!!! $$$ ||| ***')").alias("text"), F.lit("en").alias("lang"),
        F.expr("if(id % 2 = 0, 'a', 'b')").alias("source"), F.lit(20).alias("n_chars"))
    labels = docs.where("doc_id < 1000").selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) as quality")
    model = co_training.co_train(docs, labels, rounds=1)
    assert fitted[2] == (fitted[1][0] + 29_000, "meta_view")  # the text view is sure of all
    assert co_training.score(docs, model).where("(score >= 0.5) != (doc_id % 2 = 0)").count() == 0


def test_co_training_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "a", 3), (2, "Some text.", "en", "a", 10)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id bigint, quality int")
    assert co_training.co_train(docs, labels) is None  # one class only
    assert {r["score"] for r in co_training.score(docs, None).collect()} == {0.5}
    view = co_training.View(tuple([0.1] * 12), 0.2)
    model = co_training.CoTrained(view, co_training.View(tuple([0.1] * 67), 0.1), 0.3)
    assert all(0 <= r["score"] <= 1 for r in co_training.score(docs, model).collect())
