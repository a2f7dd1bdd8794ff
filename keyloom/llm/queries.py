"""One registered query per operator, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm import co_training, collocations, gru_scoring, merkle, packing, quality_rules, quotes, secret_scan, simhash_anchors, token_counts, toxicity, tree_bpe, uniform_threshold
from keyloom.llm.common import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 2048 tokens."""
    pieces = packing.pack(_documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quotation_linking(spark, sf_dir):
    """All messages in reply order, without quotes."""
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op3_secret_scans(spark, sf_dir):
    """Spans of secrets in all documents."""
    docs = _documents(spark, sf_dir)
    found = secret_scan.find_secrets(docs, common=secret_scan.common_words(docs))
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(secrets, s -> s.kind in ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(F.expr(listed.format(base)), 256).alias("base_sha256"),
        F.expr(listed.format("secrets")).alias("spans"),
    )


def op4_quality_co_training(spark, sf_dir):
    """Quality of all documents by text and metadata."""
    docs = table(spark, sf_dir, "documents")
    model = co_training.co_train(docs, table(spark, sf_dir, "labels"))
    return co_training.score(docs, model).withColumn("kept", F.col("score") >= 0.5)


def op5_exact_top_k(spark, sf_dir):
    """The five nearest of every fiftieth vector by integer inner product."""
    return uniform_threshold.top_k(table(spark, sf_dir, "embeddings"))


def op6_bpe_tree(spark, sf_dir):
    """Ids of all documents, and the bytes they decode to."""
    coded = tree_bpe.round_trip(_documents(spark, sf_dir)).select("doc_id", "coded.*")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_line_quality(spark, sf_dir):
    """Figures and verdicts of line-first cleaning on all documents."""
    rules = quality_rules.clean_lines(_documents(spark, sf_dir))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars")
    return rules.select("doc_id", *(F.col(f"rules.{n}").alias(n) for n in names))


def op8_toxicity(spark, sf_dir):
    """Toxicity of all documents, learnt from labels that are not held out."""
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of all documents."""
    found = simhash_anchors.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_counts(spark, sf_dir):
    """Bytes and tokens of all documents."""
    counted = token_counts.count_tokens(_documents(spark, sf_dir))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op11_collocations(spark, sf_dir):
    """The first 2000 phrases of each language in all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_gru_scoring(spark, sf_dir):
    """Log-probabilities of all documents, learnt from those that are not held out."""
    return gru_scoring.log_probabilities(_documents(spark, sf_dir))


def op13_merkle_manifest(spark, sf_dir):
    """Leaves, proofs and roots of all documents; every fifth is verified with its text changed."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(docs, changed={"text": F.when(tampered, lowered).otherwise(F.col("text"))})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_packing,
        op2_quotation_linking,
        op3_secret_scans,
        op4_quality_co_training,
        op5_exact_top_k,
        op6_bpe_tree,
        op7_line_quality,
        op8_toxicity,
        op9_simhash_near_dedup,
        op10_token_counts,
        op11_collocations,
        op12_gru_scoring,
        op13_merkle_manifest,
    )
}

ORACLE: dict[str, str] = {
    "op5_exact_top_k": """
        WITH rows AS (
            SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
}
