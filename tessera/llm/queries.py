"""Queries over the test tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, op1_quality, op2_jaccard, op3_html, op4_decontaminate, op5_counts, op6_mix, op7_embeddings, op8_chunks, op9_tokens, op10_substrings


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return op1_quality.score(docs, op1_quality.train(docs, _read(spark, sf_dir, "labels")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_jaccard.groups(_read(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_html.extract(_read(spark, sf_dir, "pages"))


def op4_decontaminate_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = op5_counts.Rollup(spark, common.scratch(spark, "counts"))
    return op5_counts.count_documents(_read(spark, sf_dir, "documents"), rollup, tokenizers={"words-1": op5_counts.words, "marks-1": op5_counts.marks})


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_mix.mix(_read(spark, sf_dir, "documents")).drop("tie")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_chunks.dedup(_read(spark, sf_dir, "documents")).drop("kept")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op9_tokens.encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_substrings.repeats(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_main_text": op3_main_text,
        "op4_decontaminate_benchmark": op4_decontaminate_benchmark,
        "op5_token_counts": op5_token_counts,
        "op6_mix_sources": op6_mix_sources,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_chunk_dedup": op8_chunk_dedup,
        "op9_token_store": op9_token_store,
        "op10_repeated_substrings": op10_repeated_substrings,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard_join": op2_jaccard.ORACLE_SQL,
        "op4_decontaminate_benchmark": op4_decontaminate.ORACLE_SQL,
        "op5_token_counts": op5_counts.ORACLE_SQL,
        "op6_mix_sources": op6_mix.ORACLE_SQL,
        "op7_near_duplicates": op7_embeddings.ORACLE_SQL,
    }
