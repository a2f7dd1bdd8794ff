"""A training corpus from the table ``documents``: each stage is one operator, written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm import packing, quality_rules, secret_scan, simhash_anchors, toxicity
from keyloom.llm.common import col, free_name, shared_folder, table


def _with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another ``text``, and its length in ``n_chars``."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5. The model learns from the labels that are not held out."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    mark = free_name(docs.columns, "toxic_score")
    return toxicity.score(docs, model, into=mark).where(F.col(mark) < 0.5).select(*map(col, docs.columns))


def clean_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines that failed."""
    mark = free_name(docs.columns, "rules")
    kept = quality_rules.clean_lines(docs, into=mark).where(F.col(f"{mark}.kept"))
    return _with_text(kept, F.col(f"{mark}.cleaned")).select(*map(col, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash_anchors.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    redacted = secret_scan.redact(docs, common=secret_scan.common_words(docs))
    return _with_text(redacted, F.col("text")).select(*map(col, docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", clean_by_rules),
    ("near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

# SQL can express neither the classifier nor the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. Each one's rows are written to the shared folder and read as the next one's."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
