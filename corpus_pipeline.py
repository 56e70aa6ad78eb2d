"""A training corpus in five stages, from documents to token shards.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of docs with the columns of documents (doc_id,
text, lang, source, n_chars); the last returns one row for each text in the token store. Stages hand over Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import op1_quality, op2_jaccard, op4_decontaminate, op6_mix, op9_tokens
from tessera.llm.common import scratch

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op1_quality.accepted(docs, op1_quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of links: five-word shingles, Jaccard similarity 0.8 or more."""
    return op2_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that benchmark items share with them."""
    return op4_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, a document as often as it is taken."""
    return op6_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, as read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    return op9_tokens.encode_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", tokens),
]

#: The classifier's fit and the tokenizer are beyond SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
