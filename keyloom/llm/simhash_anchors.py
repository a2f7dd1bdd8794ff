"""SimHash near-duplicates by anchor points of a covering code.

Anchors are the pairs of codewords of the binary Golay code over bits 0-22 and
23-45 of a fingerprint. That code is perfect: each 23-bit word is within distance
3 of exactly one codeword, so each fingerprint has one home anchor, at most 3 bits
away on either part. A fingerprint that differs from it by t bits in all differs by
s and at most t - s bits on the two parts, so it lies within 3 + s and 3 + t - s bits
of that home. It is sent to every anchor within such a distance (about 60 for two
bits) and there compared with the fingerprints at home. No link is missed, and
of two linked fingerprints the larger visits the smaller.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut, free_name, quoted
from keyloom.llm.components import components

MAX_BITS = 2
SHINGLE = 3
SEED = 42

# The binary Golay code: word length, checked bits, covering radius, generator polynomial (fixed values).
LENGTH, CHECK, RADIUS, GENERATOR = 23, 11, 3, 0xC75
_WORD = (1 << LENGTH) - 1
_ROWS = 1024  # fingerprints whose visits are one batch


def fingerprint(text: str) -> int:
    """64 majority bits over the hashes of the word shingles of ``text``, repeats included; 0 without words."""
    words = text.encode("utf-8").lower().split()  # A-Z and the six ASCII white space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digests = b"".join([xxhash.xxh64_digest(joined[i:j], SEED) for i, j in spans])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", into: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a long of the same bits; 0 for null and empty texts. No shuffle."""

    @F.pandas_udf("bigint")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t or "") for t in texts], dtype=np.uint64).view(np.int64))

    return df.withColumn(into, made(col(text)))


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial; 0 for codewords."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK)), rest)
    return rest


@lru_cache(maxsize=2)
def patterns(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 23-bit words of weight ``most`` at most, by syndrome: the words, their weights, where each syndrome starts.

    The codewords within that distance of a word are the word changed by the patterns of its syndrome.
    """
    words = np.array([sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(LENGTH), k)], dtype=np.int64)
    by = syndrome(words)
    order = np.lexsort((np.bitwise_count(words), by))
    starts = np.searchsorted(by[order], np.arange((1 << CHECK) + 1))
    return words[order], np.bitwise_count(words[order]).astype(np.int64), starts


def _near(words: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word the codewords within ``most`` bits: position of the word, codeword, distance."""
    pattern, weight, starts = patterns(most)
    s = syndrome(words)
    n = starts[s + 1] - starts[s]
    at = np.repeat(np.arange(len(words)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[s], n)
    return at, words[at] ^ pattern[k], weight[k]


def home_anchors(fps: np.ndarray) -> np.ndarray:
    fps = fps.view(np.uint64)
    low, high = (fps & np.uint64(_WORD)).astype(np.int64), (fps >> np.uint64(LENGTH) & np.uint64(_WORD)).astype(np.int64)
    return _near(high, RADIUS)[1] << LENGTH | _near(low, RADIUS)[1]


def visited_anchors(fps: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Anchors at which a fingerprint within ``most`` bits may be at home: position of the fingerprint, anchor."""
    fps = fps.view(np.uint64)
    low, high = (fps & np.uint64(_WORD)).astype(np.int64), (fps >> np.uint64(LENGTH) & np.uint64(_WORD)).astype(np.int64)
    i, a, da = _near(low, RADIUS + most)
    j, b, db = _near(high, RADIUS + most)
    n = np.bincount(j, minlength=len(fps))
    first = np.cumsum(n) - n
    pair = np.repeat(np.arange(len(i)), n[i])
    other = np.arange(n[i].sum()) - np.repeat(np.cumsum(n[i]) - n[i], n[i]) + np.repeat(first[i], n[i])
    near = np.maximum(da[pair] - RADIUS, 0) + np.maximum(db[other] - RADIUS, 0) <= most
    return i[pair[near]], b[other[near]] << LENGTH | a[pair[near]]


def linked_fingerprints(distinct: DataFrame, fp: str = "fp", most: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints in ``distinct`` that differ by ``most`` bits at most.

    Fingerprints that are not linked meet at an anchor by chance only, once in 2**24
    visits; the join tests them as they meet and makes no row of them. Anchors that very many
    fingerprints visit are split by adaptive execution.
    """
    source = distinct.select(col(fp).alias("fp"))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(home_anchors(fps)), batch.column(0)], ["anchor", "a"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), _ROWS):
                i, anchor = visited_anchors(fps[at : at + _ROWS], most)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fps[at + i])], ["anchor", "b"])

    at_home = source.mapInArrow(homes, "anchor bigint, a bigint")
    visiting = source.mapInArrow(visits, "anchor bigint, b bigint")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most
    return visiting.join(at_home.hint("shuffle_hash"), [visiting["anchor"] == at_home["anchor"], F.col("a") < F.col("b"), near]).select("a", "b")


def _first_of_class(rows: DataFrame, most: int) -> DataFrame:
    """For each fingerprint in ``rows`` (key, fp) the smallest key of its component: fp, first."""
    distinct = cut(rows.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(linked_fingerprints(distinct, most=most)).select(F.col("node").alias("fp"), "root")
    classes = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = cut(classes.groupBy("root").agg(F.min("least").alias("first")))  # so that a class of very many fingerprints is split in the join
    return classes.join(first, "root").select("fp", "first")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: ``key``, ``fp`` (long), ``component_id``.

    Fingerprints of all texts are linked where they differ by ``most`` bits at most;
    a component is what links reach, named by its smallest ``key``. Copies share a
    fingerprint, which is linked once, so a group of copies of any size costs no
    pairs. Null and empty texts have fingerprint 0 and are linked like others. Null
    keys name no component: one of nothing but null keys is null. Repeated rows stay.
    Extra columns play no part.
    """
    rows = cut(fingerprints(df.select(col(key).alias("key"), col(text).alias("text"))).select("key", "fp"))
    found = rows.join(_first_of_class(rows, most), "fp")
    return found.select(F.col("key").alias(key), "fp", F.col("first").alias("component_id"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_BITS) -> DataFrame:
    """The rows of ``df``, all columns, but only one of each component of near-duplicates.

    That is the row with the smallest key, null keys last; of equal keys the row with
    the smallest hash of all columns; of rows that are equal in all columns one.
    """
    row = [free_name(df.columns, n) for n in ("row_hash", "row_hash_2")]
    hashed = df.select("*", F.xxhash64(*map(col, df.columns)).alias(row[0]), F.hash(*map(col, df.columns)).alias(row[1]))
    ident = F.struct(col(key).isNull().alias("none"), col(key).alias("key"), col(row[0]).alias("h1"), col(row[1]).alias("h2"))
    rows = cut(fingerprints(hashed.select(ident.alias("key"), col(text).alias("text"))).select("key", "fp"))
    kept = _first_of_class(rows, most).select("first").distinct()
    times = rows.groupBy("key").agg(F.count("*").alias("times"))
    kept = cut(kept.join(times, kept["first"] == times["key"]).select("first.*", "times"))
    same = (hashed[row[0]] == kept["h1"]) & (hashed[row[1]] == kept["h2"]) & hashed[quoted(key)].eqNullSafe(kept["key"])
    found = hashed.join(kept.withColumnRenamed("times", row[0] + "_times"), same).select(*(hashed[quoted(c)] for c in df.columns), F.col(row[0] + "_times"))
    once = found.where(F.col(row[0] + "_times") == 1).select(*map(col, df.columns))
    again = found.where(F.col(row[0] + "_times") > 1).select(*map(col, df.columns))
    return once.unionByName(again.distinct())
