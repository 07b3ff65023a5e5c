"""Exact duplicates by deterministic block naming (prefix-doubling names), in DataFrame functions only.

A text is cut into blocks of ``BLOCK`` bytes. The distinct blocks are sorted and numbered, each pair of neighbouring
names is sorted and numbered again, and so on, until a text has a single name. Names come from a sort, never from a
hash, so two texts share their last name exactly if they are equal. A text that is alone with its length and its first
``HEAD`` characters already has an identity of its own and is not named further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, fold_ascii

BLOCK = 512
HEAD = 128


def name_rows(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``name``: an integer for each distinct value of ``keys``, increasing in their order.

    Sorted ranges are numbered side by side, so no task sees all values; a repeated task gets the same rows in the
    same order and gives the same numbers.
    """
    ranges = df.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    return df.join(ranges.withColumn("name", F.monotonically_increasing_id()), list(keys)).drop(*keys)


def identify(rows: DataFrame, work: Workspace, block: int = BLOCK) -> DataFrame:
    """``uid, level, name`` for rows of ``uid, body`` (binary, not null): equal bodies and only they share level and name."""
    width = F.greatest(F.ceil(F.octet_length("body") / block).cast("int"), F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.struct(i.alias("pos"), F.substring(F.col("body"), i * block + 1, F.lit(block)).alias("block")),
    )
    level = rows.select("uid", width.alias("width"), F.explode(cut).alias("cut")).select("uid", "width", "cut.*")
    names = work.settle(name_rows(level, "block"), "names-0")
    widest = names.agg(F.max("width")).first()[0] or 1
    done, step = [names.where("width = 1").select("uid", F.lit(0).alias("level"), "name")], 0
    while widest > 1:
        step, widest = step + 1, (widest + 1) // 2
        side = F.col("pos") % 2
        pairs = names.where("width > 1").groupBy(
            "uid", F.floor((F.col("width") + 1) / 2).cast("int").alias("width"), F.floor(F.col("pos") / 2).cast("int").alias("pos"),
        ).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left_name"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right_name"),
        )
        names = work.settle(name_rows(pairs, "left_name", "right_name"), f"names-{step}")
        done.append(names.where("width = 1").select("uid", F.lit(step).alias("level"), "name"))
    identities = done[0]
    for part in done[1:]:
        identities = identities.unionByName(part)
    members = work.settle(identities, "identities")
    work.drop(*(f"names-{i}" for i in range(step + 1)))
    return members


def exact_duplicates(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The largest id of a group
    stays; ids that are null count as smaller than all others, and a group with null ids only has a null ``keep_id`` and
    keeps them. Rows that repeat an id and its text share their decision. Other columns are not read. No rows give no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    keyed = base.select("*", F.octet_length("text").alias("n_bytes"), fold_ascii(F.left("text", F.lit(HEAD))).alias("head"))
    shared = keyed.groupBy("n_bytes", "head").count().where("count > 1").select("n_bytes", "head", F.lit(True).alias("shared"))
    tagged = keyed.join(shared, ["n_bytes", "head"], "left").withColumn("text", fold_ascii(F.col("text"))).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.when(F.col("shared"), F.encode("text", "utf-8")).alias("body"),
    )
    tagged = work.settle(tagged, "tagged")
    identities = identify(tagged.where("body IS NOT NULL").select("uid", "body"), work)
    members = work.settle(
        tagged.where("body IS NOT NULL").select("uid", "doc_id", "text_sha256").join(identities, "uid").drop("uid"), "members")
    groups = members.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    alone = tagged.where("body IS NULL").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    return members.join(groups, ["level", "name"]).select(*columns).unionByName(alone.select(*columns))


ORACLE_SQL = """
WITH folded AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), grouped AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM folded JOIN grouped USING (body)
"""
