"""The queries opN_<name>: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(table: DataFrame) -> DataFrame:
    """A table of far fewer splits than there are cores is one small file: dealt out, so that all cores work on it."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if 4 * table.rdd.getNumPartitions() <= cores else table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.topk import top_k

    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.quality import classify

    return classify(_spread(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.packing import pack_documents

    return pack_documents(_spread(_table(spark, sf_dir, "documents")), _vocabulary("word_bpe_49k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.langid import predict_languages

    return predict_languages(_spread(_table(spark, sf_dir, "documents")))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.surrogate import replace_entities

    replaced = replace_entities(_spread(_table(spark, sf_dir, "documents")))
    return replaced.select("doc_id", "text", "n_entities")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.htmltext import extract_text

    return extract_text(_spread(_table(spark, sf_dir, "pages")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.dedup import group_members

    return group_members(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.simhash import near_duplicates

    return near_duplicates(_spread(_table(spark, sf_dir, "documents")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.llm.unigram import token_counts

    return token_counts(_spread(_table(spark, sf_dir, "documents")), _vocabulary("piece_bpe_32k.model"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidegauge.llm.bytebpe import encode_digests

    return encode_digests(_spread(_table(spark, sf_dir, "documents")), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k_search": op1_top_k_search,
    "op2_quality": op2_quality,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_surrogates": op5_surrogates,
    "op6_html_text": op6_html_text,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_byte_bpe": op10_byte_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op1_top_k_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op7_exact_dedup": r"""
        WITH hashed AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM hashed
    """,
}
