"""Quality by co-training: text content and page metadata teach each other.

One classifier sees figures of the text alone, the other the metadata alone. In
each round both learn from the labelled rows and from all unlabelled rows
of which the other was sure in the round before. Both are then calibrated
on labelled rows that they did not learn from, and their log odds are added up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col, cut, sampled

SAMPLE = 20_000  # labelled rows that are learnt from or calibrated on, about
ROUNDS = 3
SURE = 0.95
SOURCES = 32  # hash buckets of each metadata column
_TASK_ROWS = 50_000  # feature rows that a task learns from, about
_LEVELS = 64  # clip of log odds
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def text_figures(text: str) -> np.ndarray:
    """Shares of kinds of characters and words."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    if not len(data):
        return np.zeros(12)
    n = np.bincount(data, minlength=256).astype(float)
    upper, lower, wide = n[65:91].sum(), n[97:123].sum(), n[128:].sum()
    space, size = n[9:14].sum() + n[32], len(data)
    words = text.split()
    count = max(len(words), 1)
    lines = text.split("\n")
    return np.array(
        [
            upper / max(upper + lower, 1),
            n[48:58].sum() / size,
            space / size,
            min(n[_SYMBOLS].sum() / count, 2),
            min(n[33] / count, 2),
            min(n[124] / count, 2),
            min(n[46] / count, 1),
            wide / size,
            len(set(words)) / count ** 0.9 if words else 0.0,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / count,
            math.log1p(len(words)) / 10,
            len(set(lines)) / len(lines),
        ]
    )


@dataclass(frozen=True)
class View:
    """A linear classifier over one array column, and its calibration ``slope * log odds + shift``."""

    weights: tuple[float, ...]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, features: Column) -> Column:
        products = F.zip_with(features, F.array(*map(F.lit, self.weights)), lambda a, b: a * b)
        raw = F.aggregate(products, F.lit(self.bias), lambda a, b: a + b)
        return F.lit(self.slope) * F.greatest(F.least(raw, F.lit(float(_LEVELS))), F.lit(float(-_LEVELS))) + F.lit(self.shift)


@dataclass(frozen=True)
class CoTrained:
    text: View
    meta: View
    prior: float  # log odds of label 1

    def score(self, text: Column, meta: Column) -> Column:
        """Both calibrated views hold the prior, so it is taken off once."""
        return probability(self.text.odds(text) + self.meta.odds(meta) - F.lit(self.prior))


def probability(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def views(df: DataFrame, text: str, metadata: Sequence[str], length: str | None) -> DataFrame:
    """``df`` with the arrays ``text_view`` and ``meta_view``; nulls count as a value of their own."""

    @F.pandas_udf("array<double>")
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_figures(t or "") for t in texts], dtype=object)

    return _with_meta(df.withColumn("text_view", figures(col(text))), metadata, length)


def _with_meta(df: DataFrame, metadata: Sequence[str], length: str | None) -> DataFrame:
    flags = []
    for name in metadata:
        bucket = F.pmod(F.xxhash64(F.coalesce(col(name).cast("string"), F.lit(""))), F.lit(SOURCES))
        flags.append(F.transform(F.sequence(F.lit(0), F.lit(SOURCES - 1)), lambda i, bucket=bucket: F.when(i == bucket, 1.0).otherwise(0.0)))
    if length:
        size = F.log1p(F.greatest(F.coalesce(col(length).cast("double"), F.lit(0.0)), F.lit(0.0))) / 10
        flags.append(F.array(size, size * size, F.when(col(length).isNull(), 1.0).otherwise(0.0)))
    return df.withColumn("meta_view", F.concat(*flags))


def _fit(rows: DataFrame, features: str, penalty: float) -> View | None:
    """None if the rows are not of two classes."""
    data = rows.select(array_to_vector(features).alias("features"), F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"))
    if data.select("label").distinct().count() < 2:
        return None
    model = LogisticRegression(maxIter=40, regParam=penalty, weightCol="weight").fit(data)
    return View(tuple(map(float, model.coefficients)), float(model.intercept))


def _calibrated(view: View, rows: DataFrame, features: str) -> View:
    scaled = _fit(rows.withColumn("odds", F.array(view.odds(F.col(features)))), "odds", 0.001)
    return view if scaled is None else View(view.weights, view.bias, scaled.weights[0], scaled.bias)


def co_train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    metadata: Sequence[str] = ("lang", "source"),
    length: str | None = "n_chars",
    label: str = "quality",
    sample: int = SAMPLE,
    rounds: int = ROUNDS,
    sure: float = SURE,
) -> CoTrained | None:
    """Learns from about ``sample`` labelled rows, drawn by hash of their key, and from all unlabelled ones.

    Each round scores all unlabelled rows. A labelled row weighs as much more as labelled rows
    were left out, so the shares of both kinds, and with them the scores, do not follow the size of the table.

    Of the labelled rows those with crc32(key) mod 5 = 0 are never used, those with 1 only
    for calibration. Null keys and labels are left out; a key labelled twice counts as 1 if one of
    its labels is. None if the labels are not of two classes. Only coefficients come to the driver.
    """
    known = labels.select(col(key).alias("key"), col(label).cast("int").alias("label")).where("key is not null and label is not null")
    known = cut(known.groupBy("key").agg(F.max("label").alias("label")))
    part = F.crc32(F.col("key").cast("string").cast("binary")) % 5
    n_known = known.count()
    used = [text, *metadata, *([length] if length else [])]
    keyed = docs.select(col(key).alias("key"), *map(col, used)).where("key is not null")
    # Figures first, so that the join moves no texts.
    figured = views(keyed, text, metadata, length).select("key", "text_view", *map(col, [*metadata, *([length] if length else [])]))
    free = cut(figured.join(known.select("key"), "key", "left_anti").drop("key"))
    free = _with_meta(free, metadata, length).select("text_view", "meta_view").coalesce(max(8, free.count() // _TASK_ROWS + 1))
    labelled = F.broadcast(sampled(known, n_known, sample))  # about `sample` rows
    stands_for = max(1.0, n_known / sample)
    rows = views(keyed.join(labelled, "key"), text, metadata, length)
    rows = cut(rows.where(part != 0).select("text_view", "meta_view", "label", F.lit(stands_for).alias("weight"), (part == 1).alias("calibrates")).coalesce(8))
    learnt, held = rows.where("not calibrates"), rows.where("calibrates")
    text_model, meta_model = _fit(learnt, "text_view", 0.001), _fit(learnt, "meta_view", 0.01)
    if text_model is None or meta_model is None:
        return None
    columns = ["text_view", "meta_view", "label", "weight"]
    for _ in range(rounds):
        by_text, by_meta = (free.withColumn("p", probability(m.odds(F.col(v)))) for m, v in ((text_model, "text_view"), (meta_model, "meta_view")))
        pseudo = [p.where((F.col("p") >= sure) | (F.col("p") <= 1 - sure)).withColumns({"label": (F.col("p") > 0.5).cast("int"), "weight": F.lit(0.5)}).select(columns) for p in (by_text, by_meta)]
        meta_model = _fit(learnt.select(columns).unionByName(pseudo[0]), "meta_view", 0.01) or meta_model
        text_model = _fit(learnt.select(columns).unionByName(pseudo[1]), "text_view", 0.001) or text_model
    ones = min(max(held.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0], 1e-3), 1 - 1e-3)
    return CoTrained(_calibrated(text_model, held, "text_view"), _calibrated(meta_model, held, "meta_view"), math.log(ones / (1 - ones)))


def score(docs: DataFrame, model: CoTrained | None, key: str = "doc_id", text: str = "text", metadata: Sequence[str] = ("lang", "source"), length: str | None = "n_chars") -> DataFrame:
    """``key``, ``score`` (probability of label 1) and the views' own ``text_score`` and ``meta_score``, for all rows.

    Null texts and metadata are scored as they are, as values of their own; without a model every score is 0.5.
    Repeated rows stay, extra columns play no part. No shuffle.
    """
    rows = views(docs, text, metadata, length)
    t, m = F.col("text_view"), F.col("meta_view")
    found = [F.lit(0.5)] * 3 if model is None else [model.score(t, m), probability(model.text.odds(t)), probability(model.meta.odds(m))]
    return rows.select(col(key), *(c.alias(n) for c, n in zip(found, ("score", "text_score", "meta_score"), strict=True)))
