"""A corpus pipeline of the training-data operators: each stage reads the documents that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ambula.llm import ngram_join, packing, quality, secrets, span_dedup
from ambula.stages import write_stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking model rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (five words, 0.8) the one of the smallest doc_id stays."""
    return ngram_join.keep_one(docs, 5, 80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans go but for their first place; documents of which nothing is left go."""
    return span_dedup.dedup_spans(docs, drop_empty=True)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("packing", packing_stage),
]

#: Models, links and tokenizers are beyond SQL; tests/llm/test_brute.py holds run() against plain Python, stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the documents of sf_dir, each written as Parquet and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_stage(docs, name)
    return docs
