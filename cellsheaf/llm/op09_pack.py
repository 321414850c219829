"""Packing of documents into training sequences: shortest-pack-first over the histogram of lengths.

A document longer than a sequence is cut into full sequences and one rest, so every length lies in
1..size and the histogram has at most `size` bins, whatever the number of documents. The
placing works on the histogram alone; the patterns it finds are joined back to the pieces by
their rank among the pieces of the same length. Only pieces (a few numbers each) are shuffled.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf.llm.common import staged
from cellsheaf.llm.tokens import encoded

SIZE = 2048
END = 1
PIECES = T.StructType().add("doc_id", "long").add("start", "long").add("length", "long").add("ids_crc32", "long").add("doc_tokens", "long")


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """Tokenize documents and cut them: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids (little-endian 32-bit)."""
    schema = T.StructType(PIECES.fields + ([T.StructField("ids", T.BinaryType())] if with_ids else []))

    def cut(batches):
        for batch in batches:
            columns = [[] for _ in schema.fields]
            for doc, ids in zip(batch.column(0).to_pylist(), encoded(path, (t.as_py() for t in batch.column(1)), end)):
                n = len(ids) // 4
                for start in range(0, n, size):
                    own = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(columns, (doc, start, len(own) // 4, zlib.crc32(own), n, own)):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first histogram packing: (lengths in a sequence, number of such sequences).

    Lengths are placed longest first, each into the shortest open packs, into as many of them
    at once as there are of either. When the shortest has no room none has: new packs are opened and
    filled with the length. A step ends a length or uses up a pattern and adds at most two patterns, so the work is
    bounded by the bins and not by the documents.
    """
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(form: tuple[int, ...], n: int) -> None:
        if n:
            packs.setdefault(sum(form), []).append((form, n))

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            low = min(packs, default=size)
            if low + length > size:
                most = size // length
                put((length,) * most, left // most)
                if left % most:
                    put((length,) * (left % most), 1)
                break
            form, n = packs[low].pop()
            if not packs[low]:
                del packs[low]
            used = min(n, left)
            put(form, n - used)
            put((*form, length), used)
            left -= used
    return [(form, n) for k in sorted(packs, reverse=True) for form, n in packs[k]]


def slots(found: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """One row for each (pattern, length): length, first rank, ranks, copies in a pattern, first sequence, offset; sorted by length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for form, n in found:
        offset = 0
        for length in sorted(set(form), reverse=True):
            copies = form.count(length)
            rows.append((length, used[length], n * copies, copies, sequence, offset))
            used[length] += n * copies
            offset += copies * length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def ranked(parts: DataFrame) -> DataFrame:
    """Add `rank`, from 0 within each length, in the order of doc_id and start.

    The rows are range-sorted by length, so a hot length spreads over many partitions, and
    written; a rank is the place in the own partition after the counts of the partitions before.
    """
    order = ["length", "doc_id", "start", "ids_crc32"]
    sorted_ = staged(parts.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    counts = sorted_.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy("part", "length").orderBy(*order[1:]))
    return sorted_.withColumn("own", own).join(first, ["length", "part"]).withColumn("rank", F.col("first") + F.col("own") - 1).drop("own", "first", "part")


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """Give each piece its sequence_id and offset.

    `parts` is read more than once and should be staged. Pieces of a sequence lie without gaps
    from offset 0. padded_length is the length of the sequence after padding: `size`, or its own length where that
    is a power of two. No pieces give an empty result; repeated rows are packed each.
    """
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = patterns(histogram, size)
    table = slots(found)
    full = np.array([sum(form) for form, _ in found], np.int64)
    starts = np.cumsum([0, *(n for _, n in found)])
    sent = parts.sparkSession.sparkContext.broadcast((table, full, starts))
    rows = ranked(parts)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "rank"]).add("sequence_id", "long").add("offset", "long").add("padded_length", "long")

    def place(batches):
        table, full, starts = sent.value
        span = np.int64(table[:, 2].max() + table[:, 1].max() + 1) if len(table) else np.int64(1)
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            slot = table[at]
            inner = rank - slot[:, 1]
            sequence = slot[:, 4] + inner // np.maximum(slot[:, 3], 1)
            offset = slot[:, 5] + inner % np.maximum(slot[:, 3], 1) * length
            own = full[np.searchsorted(starts, sequence, "right") - 1] if len(full) else length
            padded = np.where(own & (own - 1) == 0, own, size)
            kept = [batch.column(f.name) for f in schema.fields[:-3]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (sequence, offset, padded))], names=schema.names)

    return rows.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most `size` ids.

    One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length. A
    null or empty text is the end id alone. Rows that repeat are packed each; a null doc_id is
    kept. Other columns of the input are not looked at. `with_ids` adds the ids themselves.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(staged(pieces(docs, path, size, end, with_ids)), size)


def op9_pack(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs)
