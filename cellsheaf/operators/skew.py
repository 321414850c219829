"""Joins that stay balanced when one key owns a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes up to which Spark may broadcast a table, as it estimates the table before it is multiplied.
SMALL_BYTES = 8 << 20


def estimated_bytes(table: DataFrame) -> int:
    """Spark's own estimate of a table's size; tables of unknown size are estimated as endless."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def lookup(
    rows: DataFrame, table: DataFrame, on: list[str], spread: list[str], how: str = "inner", copies: int = 32, small: int = SMALL_BYTES
) -> DataFrame:
    """Join a table that has few rows per key onto many rows.

    A table estimated as small is joined as it is, which moves no rows. For any other, a key that
    owns a third of all rows is cut into `copies` sub-keys by a hash of the `spread` columns, the
    table is repeated that often, and the join is a shuffle: Spark's estimate leaves the copies
    out and must not choose a broadcast.
    """
    if estimated_bytes(table) <= small:
        return rows.join(table, on, how)
    left = rows.withColumn("_sub", F.pmod(F.xxhash64(*spread), F.lit(copies)))
    right = table.withColumn("_sub", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    return left.join(right.hint("merge"), [*on, "_sub"], how).drop("_sub")
