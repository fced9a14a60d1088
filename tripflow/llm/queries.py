"""The registered queries of these operators: each over its whole table, at production settings."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (
    alignment,
    bpe,
    fingerprints,
    lexical_search,
    licenses,
    line_quality,
    mixing,
    near_dedup,
    quality_classifier,
    sharding,
    training_order,
    url_filters,
    vector_dedup,
)

DIGEST_WIDTH = 4
TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A vocabulary file, which every worker has in the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it.

    On a cluster the package is shipped with the job instead.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(_table(spark, folder, "documents"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, folder, "documents"))


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, folder, "pages"))


def op4_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.verdicts(_table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(
        _table(spark, folder, "documents"), tokenizer_path(), digests=True
    )


def op6_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, folder, "documents"))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    forest = quality_classifier.train(docs, _table(spark, folder, "labels"))
    return quality_classifier.score_documents(docs, forest)


def op9_training_order(spark: SparkSession, folder: str) -> DataFrame:
    records = training_order.materialise(_table(spark, folder, "documents"), tokenizer_path())
    return records.select(
        "slot", "shard", "doc_id", "number", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op10_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    params = near_dedup.NearParams(width=DIGEST_WIDTH)
    return near_dedup.components(_table(spark, folder, "documents"), params)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (_table(spark, folder, name) for name in ("documents", "benchmark"))
    return lexical_search.search(docs, items)


def op12_vector_copies(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.linked_vectors(_table(spark, folder, "embeddings"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return alignment.align_documents(docs, *map(tokenizer_path, ALIGNED))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_mix_sources,
        op2_fingerprints,
        op3_url_filters,
        op4_line_quality,
        op5_bpe,
        op6_shards,
        op7_licenses,
        op8_quality,
        op9_training_order,
        op10_near_copies,
        op11_lexical_search,
        op12_vector_copies,
        op13_token_alignment,
    )
    return {query.__name__: query for query in found}
