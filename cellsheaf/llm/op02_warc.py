"""Deterministic sharded WARC archives: range-sorted records in files rolled by compressed size, and their reader.

A payload that is met again is written as a revisit record without its bytes, so it isn't
shuffled either. Records are sorted by (url, page_id); a task writes its range as files
part-PPPPPP-RRR.warc.gz with one gzip member for each record. Dates, ids, headers and digests follow from the
page alone, so another attempt of a task writes the same bytes. A file is written under a
temporary name and renamed when it is whole; files count once the manifest, a table with a
row for each file, has been written behind all tasks.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import join_groups, shared_folder, staged
from cellsheaf.llm.storage import attempt_name, committed, opened

#: Payloads of fewer bytes are always written.
LEAST_BYTES = 100
ROLL_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "part long, roll long, path string, records long, bytes long, sha256 string"
ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html (null for revisits), digest, bytes, refers_to (null for responses).

    Of pages with equal payloads of at least `least` bytes, that with the smallest page_id is the response. A null
    html is the empty payload. A page without id revisits one that has an id; rows that repeat the
    smallest page_id are all responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"),
    )
    again = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    met = join_groups(rows, staged(again), ["digest"], "n", rows.count(), 120)
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return met.select("page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "digest", "bytes", refers.alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _uri(url: str | None) -> str:
    """A header value: white space and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", len(block))])
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + member.flush()


def page_record(page_id: int | None, url: str | None, html: str | None, digest: str, size: int, refers_to: int | None) -> bytes:
    payload = (html or "").encode() if refers_to is None else None
    if payload is not None:
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", _uri(url))] if url else []
    fields += [("WARC-Payload-Digest", f"sha256:{digest}")]
    fields += [("X-Page-ID", page_id)] if page_id is not None else []
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", refers_to)]
    return _record([*fields, ("Content-Type", "application/http; msgtype=response")], http + (payload or b""))


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, least: int = LEAST_BYTES) -> DataFrame:
    """Write archives and return the manifest: one row for each file. No pages give an empty manifest."""

    def write(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        store, root = opened(folder)
        part, attempt = TaskContext.get().partitionId(), attempt_name()
        rows = chain.from_iterable(zip(*(c.to_pylist() for c in piece.columns)) for b in batches for piece in (b.slice(i, 256) for i in range(0, b.num_rows, 256)))
        row, roll = next(rows, None), 0
        while row is not None:
            name = f"{root}/part-{part:06d}-{roll:03d}.warc.gz"
            records, size, digest = 0, 0, hashlib.sha256()
            with committed(store, name, attempt) as out:
                info = "software: cellsheaf\r\nformat: WARC File Format 1.1\r\n".encode()
                own = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id_of_file(part, roll)), ("WARC-Date", DATE), ("WARC-Filename", name.rpartition("/")[2]), ("Content-Type", "application/warc-fields")]
                data = _record(own, info)
                while True:
                    out.write(data)
                    digest.update(data)
                    size += len(data)
                    if row is None or (records and size >= roll_bytes):
                        break
                    data = page_record(*row)
                    records, row = records + 1, next(rows, None)
            values = [part, roll, name, records, size, digest.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["part", "roll", "path", "records", "bytes", "sha256"])
            roll += 1

    order = ["url", "page_id", "digest"]
    rows = with_revisits(pages, least).repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(rows.mapInArrow(write, MANIFEST))


def record_id_of_file(part: int, roll: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'file:{part}:{roll}')}>"


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one record in memory at a time; raises on a broken one."""
    left = b""
    while True:
        member, out = zlib.decompressobj(31), []
        data = left or stream.read(1 << 20)
        if not data:
            return
        while not member.eof:
            if not data:
                raise ValueError("an archive ends within a record")
            out.append(member.decompress(data))
            data = b"" if member.eof else stream.read(1 << 20)
        left = member.unused_data
        head, _, rest = b"".join(out).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = rest[:size]
        if not version.startswith("WARC/1.") or rest[size:] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError("a record is broken")
        yield fields, block


def read_warc(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each page record of the files of a manifest: ROWS and, if asked for, the payload (null for revisits).

    Digest and length of a response are those of the payload read; a digest that differs from the header's raises.
    """

    def read(batches):
        store, _ = opened(folder)
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with store.open_input_stream(name, compression=None) as f:
                    rows = []
                    for fields, block in records(f):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        if fields["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"{name}: a payload is broken")
                        page, refers = (int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page"))
                        rows.append((page, fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], refers, payload if fields["WARC-Type"] == "response" else None))
                        if len(rows) == 512:
                            yield made(rows)
                            rows = []
                    if rows:
                        yield made(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    n = 7 if with_payload else 6

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[:n], kinds)], names=names[:n])

    return manifest.select("path").repartition(max(1, manifest.count()), "path").mapInArrow(read, ROWS + (", payload binary" if with_payload else ""))


def op2_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    back = read_warc(write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
