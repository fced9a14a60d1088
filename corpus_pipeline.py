"""A training corpus from ``documents``: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import bpe, line_quality, mixing, near_dedup, quality_classifier
from tripflow.llm.common import saved
from tripflow.llm.queries import importable, tokenizer_path

#: No SQL states the trees, the drawn copies or the tokens.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are removed; documents that lose too much of their text go."""
    importable(spark)
    return line_quality.clean(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that boosted trees do not predict to be good go.

    The trees are fitted on the labels of the documents as they are here, failing lines removed.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    importable(spark)
    return near_dedup.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a row per copy."""
    importable(spark)
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per copy."""
    importable(spark)
    return bpe.encode_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier_stage),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
