"""Corpus pipeline: five stages over ``documents``, each one operator of
``starloom.llm``. A stage takes (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``docs`` as they came, whatever further columns there are.

Nulls, empty texts and tables, repeated rows and long texts are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe_codec, decontaminate, quality_rules, secret_scan, simhash
from starloom.llm.common import stage, table
from starloom.llm.queries import BYTE_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules or the forest reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents contaminated with benchmark passages."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; documents stay and ``n_chars`` is recounted."""
    out = secret_scan.redact(docs, BYTE_BPE)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document left."""
    return bpe_codec.token_digests(bpe_codec.encode_decode(docs, BYTE_BPE))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("bpe_encoding", encoding),
]

# Tokenizers, forests and Hamming components are beyond SQL; the tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
