"""Log-probabilities of whole documents under a gated recurrent language model.

All training documents are counted, and each is learnt from once: in every round replicas
of the model read their shards by truncated backpropagation, and the mean of what they
end with begins the next round. The most frequent words have a number in the model;
others are told apart within a tail class by their counts, which are joined on Spark.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut, shared_folder
from keyloom.llm.gru_model import Gru
from keyloom.llm.gru_model import score as score_documents
from keyloom.llm.gru_model import train as train_pass

HEAD = 1024  # words with a number in the model, the end of a document among them
TAILS = 32  # classes of all other words
NEAR = 300_000  # most frequent words whose counts are sent to every task: about 5 MB
ROUNDS = 4
SHARD_TOKENS = 2_000_000  # that a replica reads in a round, about
RATE = 0.1
_FAN_IN = 32  # replicas that are averaged in one group: 13 MB
_DISTINCT = 400_000  # different words that a task counts before it hands them on
_PIECE = 4 << 20  # bytes of text that are split into words at once; a longer text is a piece of its own
END = b""  # a token like others; no word is empty


def _pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in pieces of about ``_PIECE`` bytes of the column ``text``."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(), dtype=np.int64)
    edges = [0, *(np.flatnonzero(np.diff(ends // _PIECE)) + 1).tolist(), len(ends)]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between blanks of all ``texts``, A-Z in lower case, each text's followed by the end; where each text begins, and the last ends."""
    texts.validate(full=True)  # raises if a text is not UTF-8
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    ended = pc.if_else(pc.equal(trimmed, ""), trimmed, pc.binary_join_element_wise(trimmed, "", " "))
    words = pc.ascii_split_whitespace(ended)
    return words.flatten().cast(pa.binary()), words.offsets.to_numpy()


def tail_of(word: bytes) -> int:
    """Class of a word without a number: by its ending."""
    return zlib.crc32(word[-3:]) % TAILS


def tails_of(words: pa.Array) -> np.ndarray:
    """:func:`tail_of` of each word."""
    endings = pc.binary_slice(words, -3).dictionary_encode()
    classes = np.array([*map(tail_of, endings.dictionary.to_pylist())], dtype=np.int16)
    return classes[endings.indices.to_numpy()]


def tail_column(word):
    """:func:`tail_of` as a column."""
    return (F.crc32(F.substring(word, F.greatest(F.octet_length(word) - 2, F.lit(1)), F.lit(3))) % TAILS).cast("int")


def is_held_out(key):
    """Documents that are not learnt from; null ids are not, either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(True))


@dataclass(frozen=True)
class Vocabulary:
    """What is sent of the counts: at most ``NEAR`` words by falling count, the end first; sums over all words."""

    words: list[bytes]
    counts: np.ndarray
    tail_mass: np.ndarray  # counts of each tail class's words, and one share for unknown words
    tail_unknown: np.ndarray  # that share: the class's words found once, one at least
    tokens: int
    distinct: int
    head: int  # words that have a number

    def model(self) -> Gru:
        return Gru.fresh(np.maximum(self.counts[: self.head], 1).astype(float), self.tail_mass.astype(float))


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of all tokens of ``docs(text)``, the end among them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for piece in _pieces(batch, 0):
                counts = pc.value_counts(words_of(piece.column(0))[0])
                found.append(pa.table(counts.flatten(), ["word", "n"]))
                if sum(map(len, found)) >= _DISTINCT:
                    found = [summed()]
                    if len(found[0]) >= _DISTINCT:
                        yield from found.pop().to_batches()
        if found:
            yield from summed().to_batches()
            found.clear()
        pa.default_memory_pool().release_unused()  # the worker lives on for later tasks

    rows = docs.select("text").mapInArrow(counted, "word binary, n bigint")
    return cut(rows.groupBy("word").agg(F.sum("n").alias("n")))


def read_vocabulary(counts: DataFrame) -> Vocabulary:
    """The sums over all words, and the most frequent ones: at most ``NEAR`` rows come to the driver."""
    sums = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    ends = counts.where(F.col("word") == F.lit(END)).select("n").first()
    top = counts.where(F.col("word") != F.lit(END)).orderBy(F.desc("n"), "word").limit(NEAR - 1).select("word", "n").toArrow()
    words = [END, *map(bytes, top.column("word").to_pylist())]
    numbers = np.array([ends["n"] if ends else 0, *top.column("n").to_pylist()], dtype=np.int64)
    head = set(words[:HEAD])
    mass, once = np.zeros(TAILS, dtype=np.int64), np.zeros(TAILS, dtype=np.int64)
    for row in counts.groupBy(tail_column(F.col("word")).alias("tail")).agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 1, 1)).alias("once")).collect():
        mass[row["tail"]], once[row["tail"]] = row["n"], row["once"]
    for word, n in zip(words[:HEAD], numbers.tolist(), strict=False):
        mass[tail_of(word)] -= n if word in head else 0
        once[tail_of(word)] -= n == 1
    unknown = np.maximum(once, 1)
    return Vocabulary(words, numbers, mass + unknown, unknown, sums["tokens"] or 0, sums["distinct"] or 0, min(HEAD, len(words)))


_ENCODED = "row bigint, key {}, held_out boolean, n_tokens bigint, known bigint, base double, tail double, ids array<smallint>, far array<struct<word: binary, n: int>>"


def _encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every document as numbers, with the sums over its near words; its far words apart, each once. Written to the shared folder."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        vocabulary = pa.array(v.words, pa.binary())
        tails = tails_of(vocabulary)
        # The last entry of each is a far word's: index -1.
        number = np.append(np.where(np.arange(len(tails)) < v.head, np.arange(len(tails)), v.head + tails), 0).astype(np.int16)
        known = np.append(v.counts > 0, False).astype(np.int64)
        base = np.append(np.log10(v.counts + 1.0), 0)
        tail = np.append(np.log10(np.maximum(v.counts, 1) / v.tail_mass[tails]), 0)
        tail[: v.head] = 0

        def numbered(piece: pa.RecordBatch) -> pa.RecordBatch:
            words, edges = words_of(piece.column(3))
            at = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy()
            ids = number[at]
            places = np.flatnonzero(at < 0)
            far = words.take(pa.array(places)).dictionary_encode()
            code, size = far.indices.to_numpy().astype(np.int64), max(1, len(far.dictionary))
            ids[places] = tails_of(far.dictionary)[code] + np.int16(v.head)
            each, tfs = np.unique((np.searchsorted(edges, places, "right") - 1) * size + code, return_counts=True)
            far_words = pa.StructArray.from_arrays([far.dictionary.take(pa.array(each % size)), pa.array(tfs, pa.int32())], ["word", "n"])
            ends = np.searchsorted(each, np.arange(len(edges)) * size)
            told = [pa.array(np.diff(edges), pa.int64()), *(pa.array(np.add.reduceat(x[at], edges[:-1])) for x in (known, base, tail))]
            numbers = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int16()))
            columns = [*piece.columns[:3], *told, numbers, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), far_words)]
            return pa.RecordBatch.from_arrays(columns, ["row", "key", "held_out", "n_tokens", "known", "base", "tail", "ids", "far"])

        for batch in batches:
            for piece in _pieces(batch, 3):
                yield numbered(piece)
                pa.default_memory_pool().release_unused()  # the worker lives on for later tasks

    path = f"{shared_folder(docs.sparkSession)}/gru-{uuid.uuid4().hex}"
    schema = _ENCODED.format(docs.schema["key"].dataType.simpleString())
    docs.select("row", "key", "held_out", "text").mapInArrow(encoded, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _mean(states: DataFrame, model: Gru) -> Gru:
    """The replicas' mean, weighted by tokens: groups of 32 are averaged on Spark until 32 are left."""

    def averaged(group: pa.Table) -> pa.Table:
        weights = group.column("tokens").to_pylist()
        total = np.zeros(len(group.column("model")[0].as_py()) // 4)
        for blob, w in zip(group.column("model"), weights, strict=True):
            total += w * np.frombuffer(blob.as_py(), np.float32)
        mean = (total / max(sum(weights), 1)).astype(np.float32).tobytes()
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py() // _FAN_IN], pa.int64()), "tokens": pa.array([sum(weights)], pa.int64()), "model": pa.array([mean], pa.binary())})

    n = states.agg(F.max("shard")).first()[0] or 0
    while n >= _FAN_IN:
        states = cut(states.groupBy(F.floor(F.col("shard") / _FAN_IN).alias("part")).applyInArrow(averaged, "shard bigint, tokens bigint, model binary"))
        n //= _FAN_IN
    rows = sorted(states.collect(), key=lambda r: r["shard"])  # 32 at most
    if not rows:
        return model
    total = sum(r["tokens"] * np.frombuffer(r["model"], np.float32).astype(float) for r in rows)
    return model.like((total / sum(r["tokens"] for r in rows)).astype(np.float32).tobytes())


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS, rate: float = RATE) -> Gru:
    """Learns from every document of ``encoded`` that is not held out, once.

    Which replica reads a document, and when, depends on the documents alone, not on how
    they are partitioned. A shard is read as a stream: none is held whole.
    """
    model = vocabulary.model()
    context = encoded.sparkSession.sparkContext
    shards = max(1, round(vocabulary.tokens / (rounds * shard_tokens)))
    part = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(rounds * shards))
    rows = encoded.where(~F.col("held_out")).select(F.floor(part / rounds).alias("shard"), (part % rounds).alias("round"), "n_tokens", "key", "ids")
    for turn in range(rounds):
        sent = context.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            def documents():
                for batch in batches:
                    ids = batch.column(1)
                    for shard, i in zip(batch.column(0).to_pylist(), range(len(ids)), strict=True):
                        yield shard, ids[i].values.to_numpy()

            stream = documents()
            ahead = next(stream, None)

            def of(shard):
                nonlocal ahead
                while ahead is not None and ahead[0] == shard:
                    ids = ahead[1]
                    ahead = next(stream, None)
                    yield ids

            while ahead is not None:
                shard, own = ahead[0], sent.value.like(sent.value.to_bytes())
                tokens, _ = train_pass(own, of(shard), 0, rate / (1 + turn))
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([tokens], pa.int64()), pa.array([own.to_bytes()], pa.binary())], ["shard", "tokens", "model"])

        # Long documents first, so that the others fill the lanes beside them.
        dealt = rows.where(F.col("round") == turn).repartitionByRange(shards, "shard").sortWithinPartitions("shard", F.desc("n_tokens"), "key", "ids")
        states = dealt.select("shard", "ids").mapInArrow(learn, "shard bigint, tokens bigint, model binary")
        model = _mean(cut(states), model)
        sent.destroy()
    return model


def _score(encoded: DataFrame, model: Gru) -> DataFrame:
    """``encoded`` without ids and far words, with ``head``: log10 probability of the numbers."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    kept = ["row", "key", "held_out", "n_tokens", "known", "base", "tail"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_batches: dict[int, list] = {}  # by number: the batch, its scores, and how many are missing
        at: list[tuple[int, int]] = []  # batch and row of each document that was begun

        def documents():
            for number, batch in enumerate(batches):
                ids = batch.column(len(kept))
                open_batches[number] = [batch, np.zeros(len(ids)), len(ids)]
                for i in np.argsort(-np.asarray(batch.column(3)), kind="stable").tolist():  # long documents first
                    at.append((number, i))
                    yield ids[i].values.to_numpy()

        for doc, value in score_documents(sent.value, documents(), 0):
            number, i = at[doc]
            held = open_batches[number]
            held[1][i] = value
            held[2] -= 1
            if not held[2]:
                del open_batches[number]
                yield pa.RecordBatch.from_arrays([*held[0].columns[:-1], pa.array(held[1])], [*kept, "head"])

    schema = ", ".join([*(f"{c} {encoded.schema[c].dataType.simpleString()}" for c in kept), "head double"])
    return encoded.select(*kept, "ids").mapInArrow(scored, schema)


def log_probabilities(df: DataFrame, key: str = "doc_id", text: str = "text", held_out=None, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per row of ``df``: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between blanks, A-Z in lower case, then one end. ``base_score`` is the
    sum of log10((c + 1) / (N + V + 1)) over them, ``c`` being a token's count among all training
    tokens, ``N`` their number, ``V`` the different ones. ``score`` is the log10 probability that the
    recurrent model gives the whole text; its state is carried through documents of any length. The model learns from all
    documents that ``held_out`` (a condition; by default one in seven, by the key's hash) leaves, each
    once. A known word outside of the model's numbers has its share of its class's counts; unknown ones
    share what the class's words found once have.

    Null and empty texts are the end alone. A null key is held out. Repeated rows each count and are each
    scored. Other columns of ``df``, whatever their names, play no part. An empty table gives no
    rows; without training documents the model is as it was at first, and nothing is known.

    Counts grow with the corpus and stay on Spark; tasks hold ``NEAR`` of them, the model (0.4 MB), and the
    documents that are being read. A far word is none of the ``NEAR`` most frequent, so no key of the join has
    more than one in ``NEAR`` of all tokens.
    """
    held = is_held_out(col(key)) if held_out is None else held_out
    docs = df.select(F.monotonically_increasing_id().alias("row"), col(key).alias("key"), held.alias("held_out"), col(text).alias("text"))
    counts = count_words(docs.where(~F.col("held_out")))
    vocabulary = read_vocabulary(counts)
    encoded = _encode(docs, vocabulary)
    model = train(encoded, vocabulary, rounds, shard_tokens)

    far = encoded.select("row", F.inline("far"))
    mass, unknown = (F.array(*[F.lit(float(x)) for x in xs]) for xs in (vocabulary.tail_mass, vocabulary.tail_unknown))
    c = F.coalesce(F.col("c"), F.lit(0))
    at = tail_column(F.col("word")) + 1
    share = F.when(c > 0, c.cast("double")).otherwise(F.element_at(unknown, at)) / F.element_at(mass, at)
    known = counts.select("word", F.col("n").alias("c"))
    sums = (
        far.join(known.hint("shuffle_hash"), "word", "left")  # different words only, and few to a partition
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("far_known"),
            F.sum(F.col("n") * F.log10(c + 1.0)).alias("far_base"),
            F.sum(F.col("n") * F.log10(share)).alias("far_tail"),
        )
    )
    zero = F.lit(0.0)
    return (
        _score(encoded, model)
        .join(sums, "row", "left")
        .select(
            F.col("key").alias(key),
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce(F.col("far_known"), F.lit(0))).alias("n_known"),
            F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce(F.col("far_base"), zero) - F.col("n_tokens") * float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))).alias("base_score"),
            (F.col("head") + F.col("tail") + F.coalesce(F.col("far_tail"), zero)).alias("score"),
        )
    )
