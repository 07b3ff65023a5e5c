"""The operators as filters and rewrites of a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exact_dedup, near_dedup, packing, quality, secrets
from .workspace import Workspace, fold_ascii


def _rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the ids and normalised texts in ``kept`` (``doc_id, text_sha256``), one of rows that repeat both.

    ``docs`` is joined by id and by the digest of its text, so other columns keep their names whatever they are.
    """
    keys = kept.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    digest = F.sha2(fold_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)

    def matching(keys: DataFrame) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"))
        return docs.join(keys, docs["doc_id"].eqNullSafe(keys["__id"]) & (digest == keys["__digest"]), "left_semi")

    if keys.where("copies > 1").isEmpty():
        return matching(keys)
    repeated = matching(keys.where("copies > 1")).withColumn("__digest", digest).dropDuplicates(["doc_id", "__digest"]).drop("__digest")
    return matching(keys.where("copies = 1")).unionByName(repeated)


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier does not reject."""
    return docs.where(quality.fit(docs, labels).column(F.col("text")) >= quality.THRESHOLD)


def drop_exact_copies(docs: DataFrame, work: Workspace) -> DataFrame:
    """The row with the largest id of equal texts."""
    return _rows_of(docs, exact_dedup.exact_duplicates(docs, work).where("kept").select("doc_id", "text_sha256"))


def drop_near_copies(docs: DataFrame, work: Workspace) -> DataFrame:
    """The row with the smallest id of each component; of several such rows the one whose text has the smallest digest."""
    digest = F.sha2(fold_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    found = near_dedup.near_duplicates(docs.select("doc_id", "text", digest.alias("text_sha256")), work, keep=("text_sha256",))
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    least = work.settle(first.groupBy("component_root").agg(F.min("text_sha256").alias("text_sha256")), "least")
    return _rows_of(docs, work.settle(first.join(least, ["component_root", "text_sha256"], "left_semi").select("doc_id", "text_sha256"), "first"))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` counted anew for them."""
    columns = docs.columns
    masked = docs.withColumn("__masked", secrets.redacted(F.col("text").cast("string")))
    changed = ~F.col("__masked").eqNullSafe(F.col("text"))
    if "n_chars" in columns:
        masked = masked.withColumn("n_chars", F.when(changed, F.length("__masked").cast("long")).otherwise(F.col("n_chars")))
    return masked.withColumn("text", F.when(changed, F.col("__masked")).otherwise(F.col("text"))).select(*columns)


def pack_documents(docs: DataFrame, definition: str, work: Workspace) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack(docs, definition, work)
