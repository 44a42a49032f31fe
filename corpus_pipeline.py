"""From raw documents to packed training sequences, in stages that are each written before the next one reads.

Every stage works on all that its predecessor kept, takes nulls, repeated rows and
empty tables as its operator defines them, and returns the columns it got (the last
returns pieces of sequences).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.dedup import keep_first
from tidegauge.llm.packing import pack_documents
from tidegauge.llm.quality import keep_good
from tidegauge.llm.simhash import keep_one
from tidegauge.llm.surrogate import replace_entities
from tidegauge.session import materialise

#: Near duplicates share four fifths of their shingles of five words.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier trained on the trusted ones rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts stays."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of least id."""
    return keep_one(docs, similarity=SIMILARITY, words_each=SHINGLE_WORDS)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates; the length follows the new text."""
    new = replace_entities(docs.withColumnRenamed("n_chars", "old_chars") if "n_chars" in docs.columns else docs)
    length = {"n_chars": F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("old_chars")).alias("n_chars")} if "n_chars" in docs.columns else {}
    return new.select(*(length.get(c, F.col(c)) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, placed in sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pii_surrogates", surrogates),
    ("best_fit_packing", packing),
]

#: Trained models and greedy packing have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
