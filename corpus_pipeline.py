"""From raw documents to packed training sequences: toxic documents, exact and near copies and benchmark passages go.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
documents. run() writes every stage's table as Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellsheaf.llm.common import staged
from cellsheaf.llm.op03_toxicity import drop_toxic
from cellsheaf.llm.op04_exact_dedup import drop_copies
from cellsheaf.llm.op06_near_dedup import keep_one
from cellsheaf.llm.op09_pack import pack_documents
from cellsheaf.llm.op10_decontaminate import drop_contaminated


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not find toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark passages."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document, with its training sequence and place in it."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: No SQL expresses the classifier, so none gives run()'s rows; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
