"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and L1 keeps most weights at exactly
zero. Shards of the labelled sample learn at the same time, each from the state
of the last round; a coordinate's new state is the mean over the shards that
met it. State and weights are bounded by the number of hash buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut, sampled
from keyloom.llm.pretokens import Memo

BITS = 18  # hash buckets: 2**18, 2 MB of weights
SAMPLE = 12_000  # labelled documents that are learnt from, about; drawn by hash of their id
SHARDS = 4
ROUNDS = 8
STEMS = (3, 5, 7)  # letters
_PUNCTUATION = ".,;:!?\"'()[]{}<>|*&%$#@+=/\\-_…«»"
# Odd factors that mix word hashes; one pair for neighbours, one for words with a gap between them.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, z: np.ndarray, n: np.ndarray, documents: list[np.ndarray], labels: list[int]) -> np.ndarray:
        """One pass, changing ``z`` and ``n``; returns the coordinates met. The last one is the bias, without L1."""
        met = np.zeros(len(z), dtype=bool)
        for features, label in zip(documents, labels, strict=True):
            at = np.append(features, len(z) - 1)
            w = self.weights(z[at], n[at])
            w[-1] = -z[-1] / ((self.beta + np.sqrt(n[-1])) / self.alpha + self.l2)
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / self.alpha
            z[at] += error - sigma * w
            n[at] += error * error
            met[at] = True
        return met


class Hasher:
    """Buckets of the words, stems, neighbours and skip-grams of a text.

    Stems are the first letters of a word; through them inflected forms that were never seen still count.
    """

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.words = Memo(self._word, 150_000)

    @staticmethod
    def _word(raw: str) -> bytes:
        word = raw.strip(_PUNCTUATION).lower()
        parts = [word, *(f"{word[:n]}~" if len(word) > n else "" for n in STEMS)]
        return b"".join(xxhash.xxh64_digest(p.encode("utf-8"))[::-1] for p in parts)

    def buckets(self, text: str) -> np.ndarray:
        found = np.frombuffer(b"".join(map(self.words.__getitem__, text.split())), "<u8").reshape(-1, 1 + len(STEMS))
        h = found[:, 0]
        grams = [found.ravel(), h[:-1] * _MIX[0] + h[1:] * _MIX[1], h[:-2] * _MIX[2] + h[2:] * _MIX[3]]
        mixed = np.concatenate(grams)
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _MIX[1]) >> self.shift).astype(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by bucket, and the bias."""

    bits: int
    at: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits)
        w[self.at] = self.weight
        return w


def held_out(key: int | str | None) -> bool:
    """Rows whose label is never learnt from. A null id is held out."""
    return key is None or zlib.crc32(str(key).encode("utf-8")) % 5 == 0


def is_held_out(key):
    """:func:`held_out` as a column."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _one_pass(ftrl: Ftrl, state, turn: int):
    """A pass of each shard in a partition over its documents, from the state of the last round: its new state, and the coordinates met."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list[tuple[np.ndarray, int]]] = {}
        for batch in batches:
            for shard, label, features in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                shards.setdefault(shard, []).append((features.values.to_numpy(), label))
        for rows in shards.values():
            rows.sort(key=lambda r: (r[0].tobytes(), r[1]))
            order = np.random.default_rng(turn).permutation(len(rows))  # the same however the rows arrived
            z, n = state.value[0].copy(), state.value[1].copy()
            met = ftrl.learn(z, n, [rows[i][0] for i in order], [rows[i][1] for i in order])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (z, n, np.packbits(met))], ["z", "n", "met"])

    return learn


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, shards: int = SHARDS, rounds: int = ROUNDS, bits: int = BITS, ftrl: Ftrl = Ftrl()) -> ToxicityModel:
    """Learns from about ``sample`` labelled documents that are not held out.

    Null ids, null labels and texts without words are left out; an id labelled
    twice counts as labelled 1 if one of the labels is. Without any labelled row
    the model is empty and scores 0.5. Features are written to the shared folder
    once, a partition to a shard. A document's shard is the hash of its id, so the model does not depend on
    how the rows came. Each round brings one row per shard to the driver, of 16 bytes per bucket: 16 MB.
    """
    known = (
        labels.select(col(key).alias("key"), col(label).cast("int").alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("key")))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    total = known.count()
    drawn = sampled(known, total, sample)  # about `sample` rows: small enough to broadcast
    rows = docs.select(col(key).alias("key"), col(text).alias("text")).join(F.broadcast(drawn), "key").select("key", "label", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            found = [np.unique(hasher.buckets(t or "")).astype(np.int32) for t in batch.column(2).to_pylist()]
            shard = [xxhash.xxh32_intdigest(str(k)) % shards for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(1).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["shard", "label", "features"])

    learnt = cut(rows.mapInArrow(features, "shard int, label int, features array<int>").where(F.size("features") > 0).repartitionById(shards, "shard"))
    context, size = docs.sparkSession.sparkContext, (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for turn in range(rounds):
        state = context.broadcast((z, n))

        states = learnt.mapInArrow(_one_pass(ftrl, state, turn), "z binary, n binary, met binary").toArrow()
        sums, times = np.zeros((2, size)), np.zeros(size)
        for own_z, own_n, met in zip(*(c.to_pylist() for c in states.columns), strict=True):
            at = np.unpackbits(np.frombuffer(met, np.uint8), count=size).astype(bool)
            sums[0, at] += np.frombuffer(own_z)[at]
            sums[1, at] += np.frombuffer(own_n)[at]
            times += at
        at = times > 0
        z[at], n[at] = sums[:, at] / times[at]
        state.destroy()
    w = ftrl.weights(z[:-1], n[:-1])
    at = np.flatnonzero(w)
    return ToxicityModel(bits, at, w[at], float(-z[-1] / ((ftrl.beta + np.sqrt(n[-1])) / ftrl.alpha + ftrl.l2)))


def score(df: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with the probability that ``text`` is toxic, from its words alone.

    Null and empty texts get the score of a text without words. A column named
    ``into`` is replaced, all others and repeated rows stay. No shuffle.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher, weights, bias = Hasher(sent.value.bits), sent.value.dense(), sent.value.bias

        def one(text):
            at = hasher.buckets(text or "")
            at = np.unique(at[weights[at] != 0])
            return 1 / (1 + np.exp(-np.clip(bias + weights[at].sum(), -35, 35)))

        for texts in batches:
            yield pd.Series(list(map(one, texts)), dtype="float64")

    return df.withColumn(into, scored(col(text)))
