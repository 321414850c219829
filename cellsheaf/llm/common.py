"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.sources.scratch import shared_folder

#: Tables are broadcast up to this many bytes, after they have been counted; larger ones are shuffled.
BROADCAST_BYTES = 16 << 20
#: A group is hot with more than one row in so many of all; there can be fewer hot groups than that.
HOT_SHARE = 1000


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the folder that all executors share, and read it again.

    It cuts the lineage: a lost executor costs the tasks of one step, and later jobs see the
    same rows in the same files. Columns without a type become strings, as Parquet has none.
    """
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"})
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fits(rows: int, row_bytes: int, bound: int = BROADCAST_BYTES) -> bool:
    return rows * row_bytes <= bound


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, row_bytes: int, bound: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join rows to the group of their (never null) keys; `groups` has each key once and is staged.

    Groups that are few enough are broadcast. Otherwise only those with more than one row in
    HOT_SHARE of `total` are, which are fewer than HOT_SHARE; their rows are spread by their whole
    numbers (ids) in the shuffle in which all others meet their group.
    """
    if fits(groups.count(), row_bytes, bound):
        return rows.join(F.broadcast(groups), keys, "left")
    own = [c for c in groups.columns if c not in keys]
    limit = total // HOT_SHARE
    hot = groups.filter(F.col(size) > limit).select(*keys, F.struct(*own).alias("__hot"))
    cold = groups.filter(F.col(size) <= limit).select(*keys, F.struct(*own).alias("__cold"), F.lit(0).alias("__salt"))
    spread = F.when(F.col("__hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if kind == "bigint"]), F.lit(1 << 20)))
    met = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", spread.cast("int")).join(cold, [*keys, "__salt"], "left")
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.coalesce(f"__hot.{c}", f"__cold.{c}").alias(c) for c in own])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns whose names the operator gives to its own."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def apart(docs: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename the columns of a table that clash with an operator's own; the function selects them again under their names."""
    taken = {n.lower() for n in names}
    held = [f"__own_{c}" if c.lower() in taken else c for c in docs.columns]
    return docs.toDF(*held), lambda out: out.select([F.col(f"`{c}`") for c in held]).toDF(*docs.columns)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
