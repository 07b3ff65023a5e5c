"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, chat, divergence, exact_dedup, html_text, near_dedup, nearest, packing, quality, secrets, token_counts, warc
from .shipping import ship_package
from .workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.format_conversations(chat.with_probe(_table(spark, sf_dir, "conversations"))))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(_table(spark, sf_dir, "documents"), _bytes("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), Workspace(spark, "near-dedup"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")  # alone on its executors, it takes larger batches than the pipeline's stage
    return packing.pack(docs, _bytes("word_bpe_49k.json").decode(), Workspace(spark, "packing"), batch_chars=8_000_000)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.document_counts(docs, _bytes("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, Workspace(spark, "token-counts"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), Workspace(spark, "exact-dedup"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ranks = (_bytes("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return alignment.align_corpus(docs, _bytes("byte_bpe_50k.json").decode(), _bytes("piece_bpe_32k.model"), Workspace(spark, "alignment"), ranks)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), Workspace(spark, "divergence"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"), Workspace(spark, "warc"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run for run in (
        op1_html_extraction, op2_chat_formatting, op3_quality_classifier, op4_secret_scans, op5_byte_bpe, op6_simhash_near_dedup,
        op7_packing, op8_nearest_neighbours, op9_token_counts, op10_exact_dedup,
        op11_cross_tokenizer_alignment, op12_source_divergence, op13_warc)
}
ORACLES: dict[str, str] = {"op2_chat_formatting": chat.ORACLE_SQL, "op10_exact_dedup": exact_dedup.ORACLE_SQL,
                           "op12_source_divergence": divergence.ORACLE_SQL, "op13_warc": warc.ORACLE_SQL}
