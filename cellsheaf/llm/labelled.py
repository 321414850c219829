"""Labels for training: a fixed fold is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import fits


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves no rest modulo 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and y (0 or 1) of the rows to learn from. Ids with two labels or none are left out."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).filter(~held_out())
    y = F.col(label).cast("int")
    return rows.groupBy("doc_id").agg(F.min(y).alias("y"), F.max(y).alias("z")).filter("y = z").drop("z")


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, text and y of chosen documents; the ids are broadcast if they are few."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return text.join(F.broadcast(chosen) if fits(chosen.count(), 24) else chosen, "doc_id")
