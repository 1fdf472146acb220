"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.llm import (
    alignment,
    exact_dedup,
    fingerprints,
    language,
    mixing,
    ngram_join,
    packing,
    pseudonyms,
    repeats,
    resampling,
    rules,
    secrets,
    spelling,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_classes(_table(spark, sf_dir, "documents"))
    return found.withColumns({x: F.hex(x) for x in ("row_key", "class_key")})


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).withColumn("row_key", F.hex("row_key"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(_table(spark, sf_dir, "documents"), words=51)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.when(F.col("n_bytes") > 0, removed / F.col("n_bytes")).otherwise(0.0).alias("removed_share"),
        F.col("n_shared").alias("n_shared_words"),
    )


def word_tokenizer() -> str:
    """The public word-wise BPE file, which lies at the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), word_tokenizer())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs.filter(language.learnable(F.col("doc_id")))))
    held_out = language.held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "ambiguous")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return rules.quality_rules(docs, labels)


def op7_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return resampling.resample(docs, labels)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


#: A key for tests; a deployment passes its own secret.
TEST_KEY = b"linkscore test key"


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(_table(spark, sf_dir, "documents"), TEST_KEY)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_literal", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_table(spark, sf_dir, "documents"), *paths)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_repeats": op3_repeats,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_quality_rules": op6_quality_rules,
    "op7_resampling": op7_resampling,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_secret_scan": op10_secret_scan,
    "op11_fingerprints": op11_fingerprints,
    "op12_alignment": op12_alignment,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
}
