"""The corpus pipeline: stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
back as the next stage's docs. All stages but the last return the columns of their input. Nulls in any
column, empty texts, repeated ids and empty tables pass through as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.llm import exact_dedup, language, mixing, ngram_join, packing
from linkscore.llm.queries import word_tokenizer
from linkscore.llm.store import Scratch

#: No source is passed over more often than this in the mix; every document is taken once at least.
MAX_PASSES = 1.5


def _meet(docs: DataFrame, keys: dict[str, Column], wanted: DataFrame) -> DataFrame:
    """The rows of docs that meet a row of wanted on the keys, one for each key, with wanted's other columns.

    The join places the rows by the keys, so leaving one of each needs no further shuffle.
    """
    rows = docs.select(F.struct("*").alias("row"), *(c.alias(k) for k, c in keys.items()))
    return rows.join(wanted.hint("merge"), list(keys)).dropDuplicates(list(keys))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those without a letter and the ambiguous go."""
    model = language.fit(docs.filter(language.learnable(F.col("doc_id"))))
    found = language.identify(docs, model, F.struct("*"), name="row")
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")).select("row.*")


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; of rows with the same id and text one."""
    kept = exact_dedup.exact_groups(docs).filter("kept")
    kept = kept.select(F.xxhash64("doc_id").alias("id_key"), F.col("text_sha256").alias("text_key"))
    text = exact_dedup.normalised(F.col("text"))
    keys = {"id_key": F.xxhash64("doc_id"), "text_key": F.sha2(text, 256)}
    return _meet(docs, keys, kept).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id, and one where ids are null or repeated."""
    kept = ngram_join.near_classes(docs).filter("row_key = class_key").select("row_key")
    return _meet(docs, {"row_key": ngram_join.row_key()}, kept).select("row.*")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix passes over it, once at least: small sources are repeated."""
    mix = mixing.mix(docs, max_passes=MAX_PASSES).groupBy("row_key").agg(F.count("*").cast("int").alias("times"))
    rows = _meet(docs, {"row_key": mixing.row_key()}, mix)
    return rows.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 4096, as packing.pack returns them."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

# Learned classifiers and tokenizers are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of a folder."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        docs = scratch.put(result) if k < len(STAGES) - 1 else result
    return docs
