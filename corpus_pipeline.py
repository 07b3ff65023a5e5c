"""From raw documents to packed training sequences: quality, exact copies, near copies, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from motefield.llm import stages
from motefield.llm.shipping import ship_package
from motefield.llm.workspace import Workspace


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return stages.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.drop_exact_copies(docs, Workspace(spark, "pipeline-exact"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return stages.drop_near_copies(docs, Workspace(spark, "pipeline-near"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return stages.mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return stages.pack_documents(docs, file.read(), Workspace(spark, "pipeline-packing"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: No SQL: the classifier, the fingerprints and the tokenizer are not expressible in it. tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
