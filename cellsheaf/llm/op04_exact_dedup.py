"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import BROADCAST_BYTES, apart, join_groups, staged, text_of, without

#: Characters of a text that the second level hashes.
PREFIX_CHARS = 256
OUTPUT = ["keep_id", "group_size", "kept", "text_sha256"]


def copy_groups(docs: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "text", bound: int = BROADCAST_BYTES) -> DataFrame:
    """Groups of two or more equal texts: __bytes, __prefix, __sha, group_size, keep_id (largest id).

    Each level looks only at the groups that the one before could not tell apart. Levels
    exchange counts that are summed before the shuffle and keys of a few bytes; a text itself
    is never shuffled. The full hash is computed behind the join with the surviving keys if
    these are few enough to be broadcast; beyond that all rows are hashed where they are read.
    """
    text = text_of(text_col)
    length, prefix = F.octet_length(text).alias("__bytes"), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("__prefix")
    lengths = staged(docs.groupBy(length).agg(F.count("*").alias("__n")).filter("__n > 1"))
    alike = join_groups(docs.select(F.col(id_col).alias("__id"), length, prefix), lengths, ["__bytes"], "__n", total, 40, bound).filter("__n is not null")
    prefixes = staged(alike.groupBy("__bytes", "__prefix").agg(F.count("*").alias("__n")).filter("__n > 1"))
    rows = docs.select(F.col(id_col).alias("__id"), length, prefix, text.alias("__text"))
    if prefixes.count() * 60 > bound:
        rows = rows.withColumn("__text", F.sha2("__text", 256))
        whole = F.col("__text")
    else:
        whole = F.sha2("__text", 256)
    left = join_groups(rows, prefixes, ["__bytes", "__prefix"], "__n", total, 60, bound).filter("__n is not null")
    full = left.groupBy("__bytes", "__prefix", whole.alias("__sha")).agg(F.count("*").alias("group_size"), F.max("__id").alias("keep_id"))
    return staged(full.filter("group_size > 1"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BROADCAST_BYTES) -> DataFrame:
    """Add keep_id, group_size, kept and text_sha256 to every document.

    The groups come from copy_groups(), which looks into whole texts only where length and prefix leave a doubt. The
    digest of every text is asked for besides, so the last scan hashes all of them where they are read.

    Texts are equal when they are identical; null counts as empty. The row with the largest id
    stays. An id that is null never wins against another; if all ids of a group are null, all its rows
    stay. Rows that repeat an id and its text are one document and share its decision. Input
    columns named like an output are replaced. An empty table gives an empty result.
    """
    docs = without(docs, OUTPUT)
    total = docs.count()
    groups = copy_groups(docs, total, id_col, text_col, bound)
    text = text_of(text_col)
    keyed = docs.withColumns(
        {"__bytes": F.octet_length(text), "__prefix": F.xxhash64(F.substring(text, 1, PREFIX_CHARS)), "__sha": F.sha2(text, 256)}
    )
    met = join_groups(keyed, groups, ["__bytes", "__prefix", "__sha"], "group_size", total, 160, bound)
    keep = F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id"))
    return met.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns."""
    held, restore = apart(docs, OUTPUT)
    return restore(mark_copies(held).filter("kept"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mark_copies(docs).select("doc_id", *OUTPUT)


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
