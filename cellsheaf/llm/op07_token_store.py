"""Binary token files: one zstandard frame for each document, under a dictionary trained on id arrays.

A file (all numbers little-endian):

    magic "TKZ1" | frames, one for each document | index | footer
    index   for each document: doc_id int64, has_id uint8, frame offset uint64, frame bytes uint32, ids uint32
    footer  documents uint64, ids uint64, index offset uint64, sha-256 of the dictionary (32 bytes), magic

Ids are unsigned 32-bit integers before compression. A short document is read by its index entry and
one frame. The dictionary lies beside the files under its hash, which every footer repeats.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf.llm.common import shared_folder, staged
from cellsheaf.llm.storage import attempt_name, committed, opened
from cellsheaf.llm.tokens import encoded

MAGIC = b"TKZ1"
END = 1
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("at", "<u8"), ("size", "<u4"), ("ids", "<u4")])
FOOTER = "<QQQ32s4s"
#: The dictionary is trained on about so many documents (chosen by the hash of id and text, twice as many at most) and ids of each.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES, LEVEL = 2000, 4096, 64 << 10, 3
FILES = "part long, path string, first_id long, documents long, ids long, bytes long, dictionary string"


def train_dictionary(docs: DataFrame, path: str, end: int = END) -> bytes:
    """A zstandard dictionary from the ids of a bounded sample; empty if there are too few documents to train one."""
    total, parts = docs.count(), 1 << 40
    share = parts if total <= SAMPLE_DOCS else parts * SAMPLE_DOCS // total
    text = F.substring(F.col("text").cast("string"), 1, 8 * SAMPLE_IDS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) < share).select(text.alias("text")).limit(2 * SAMPLE_DOCS)
    arrays = [ids[: 4 * SAMPLE_IDS] for ids in encoded(path, (r["text"] for r in sample.toLocalIterator()), end)]
    arrays = [a for a in arrays if len(a) >= 8]
    if len(arrays) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # the library finds too little that repeats
        return b""


def _codec(dictionary: bytes, kind):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return kind(dict_data=known, **({"level": LEVEL} if kind is zstandard.ZstdCompressor else {}))


def write_store(docs: DataFrame, path: str, folder: str, end: int = END) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns one row for each file (FILES), in order by `part`.

    The table is range-partitioned by doc_id; each task tokenizes its documents, writes one file under
    a temporary name and renames it when it is whole. Null doc_ids come first. The rows of
    equal doc_id are written next to each other. Text null is the end id alone.
    """
    store, root = opened(folder)
    dictionary = train_dictionary(docs, path, end)
    digest = hashlib.sha256(dictionary).digest()
    with committed(store, f"{root}/{digest.hex()}.dict", "driver") as out:
        out.write(dictionary)
    sent = docs.sparkSession.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = opened(folder)
        name = f"{root}/part-{part:06d}.tkz"
        codec, index, at, ids_n = _codec(sent.value, zstandard.ZstdCompressor), [], len(MAGIC), 0
        with committed(store, name, attempt_name()) as out:
            out.write(MAGIC)
            for batch in chain([first], batches):
                for doc, ids in zip(batch.column(0).to_pylist(), encoded(path, (t.as_py() for t in batch.column(1)), end)):
                    frame = codec.compress(ids)
                    out.write(frame)
                    index.append((doc or 0, doc is not None, at, len(frame), len(ids) // 4))
                    at, ids_n = at + len(frame), ids_n + len(ids) // 4
            table = np.array(index, ENTRY)
            out.write(table.tobytes())
            out.write(struct.pack(FOOTER, len(table), ids_n, at, digest, MAGIC))
        row = [part, name, int(table["doc_id"][0]), len(table), ids_n, at + table.nbytes + struct.calcsize(FOOTER), digest.hex()]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["part", "path", "first_id", "documents", "ids", "bytes", "dictionary"])

    rows = docs.select("doc_id", F.col("text").cast("string")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(rows.mapInArrow(write, FILES))


def read_file(store, name: str, entries: slice = slice(None)) -> Iterator[tuple[int | None, bytes]]:
    """Documents of a file by their place in the index: doc_id and ids. Raises if the file or its dictionary isn't whole."""
    with store.open_input_file(name) as f:
        size = f.size()
        n, ids_n, at, digest, magic = struct.unpack(FOOTER, f.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is not a token file")
        index = np.frombuffer(f.read_at(n * ENTRY.itemsize, at), ENTRY)
        with store.open_input_file(f"{name.rpartition('/')[0]}/{digest.hex()}.dict") as d:
            dictionary = d.read()
        if hashlib.sha256(dictionary).digest() != digest or int(index["ids"].sum()) != ids_n:
            raise ValueError(f"{name} has another dictionary or index")
        codec = _codec(dictionary, zstandard.ZstdDecompressor)
        for doc, has, start, length, ids in index[entries].tolist():
            out = codec.decompress(f.read_at(length, start), max_output_size=4 * ids)
            if len(out) != 4 * ids:
                raise ValueError(f"{name}: a frame is broken")
            yield doc if has else None, out


def read_store(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Read all files back: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked for, ids.

    Files hold consecutive ranges, so the start of a file is the sum over those before it; there is one
    row in that sum for each file, and one task reads one file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    schema = T.StructType().add("doc_id", "long").add("start", "long").add("n_tokens", "long").add("ids_crc32", "long")
    schema = T.StructType(schema.fields + ([T.StructField("ids", T.BinaryType())] if with_ids else []))

    def read(batches):
        store, _ = opened(folder)
        for batch in batches:
            for name, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                columns = [[] for _ in schema.fields]
                for doc, ids in read_file(store, name):
                    for column, value in zip(columns, (doc, start, len(ids) // 4, zlib.crc32(ids), ids)):
                        column.append(value)
                    start += len(ids) // 4
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    n = max(1, files.count())
    return placed.repartition(n, "path").mapInArrow(read, schema)


def op7_token_store(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = shared_folder(spark)
    return read_store(write_store(docs, public_tokenizers.path("word_bpe_49k.json"), folder), folder)
