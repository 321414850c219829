import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from cellsheaf.llm.common import shared_folder
from cellsheaf.llm.op02_warc import read_warc, records, write_warc
from cellsheaf.llm.storage import opened


def pages():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<p>page {i % 40} é</p>" * (i % 40)) for i in range(200)]
    rows += [(500, None, None), (501, "", ""), (502, "http://x/a b\r\nc", "x" * 99), (503, "u", "x" * 99), (504, "u", "y" * 100), (505, "u", "y" * 100)]
    return rows + [(3, "again", "same id " * 20), (3, "again", "same id " * 20), (None, "no id", "y" * 100), (None, None, "z" * 300), (600, "long", "\r\n\r\nlong" * 200_000)]


def want(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        data, refers = (h or "").encode(), first.get(h)
        refers = refers if refers is not None and refers != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("bytes", F.lit(1)).repartition(4)
    kept = []
    for _ in range(2):
        folder = shared_folder(spark)
        manifest = write_warc(table, folder, roll_bytes=3000)
        back = read_warc(manifest, folder, with_payload=True).collect()
        assert sorted(((r["page_id"], *r[2:6]) for r in back), key=repr) == want(pages())
        assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in back if r["record_type"] == "response")
        files = manifest.orderBy("part", "roll").collect()
        assert len(files) > manifest.select("part").distinct().count()
        kept.append([(r["part"], r["roll"], r["records"], r["sha256"]) for r in files])
        store, root = opened(folder)
        with store.open_input_stream(files[0]["path"], compression=None) as f:
            data = f.read()
        assert hashlib.sha256(data).hexdigest() == files[0]["sha256"] and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        names = [x.base_name for x in store.get_file_info(__import__("pyarrow").fs.FileSelector(root))]
        assert sorted(n for n in names if n.endswith(".gz")) == sorted(r["path"].rpartition("/")[2] for r in files) and not any("tmp" in n for n in names)
    assert kept[0] == kept[1]


def test_empty_table_and_broken_archive(spark):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string")
    folder = shared_folder(spark)
    assert read_warc(write_warc(table.limit(0), folder), folder).count() == 0
    file = write_warc(table.limit(5), folder).first()
    store, _ = opened(folder)
    with store.open_input_stream(file["path"], compression=None) as f:
        data = f.read()
    import io

    assert sum(1 for _ in records(io.BytesIO(data))) == file["records"] + 1
    with pytest.raises(ValueError):
        list(records(io.BytesIO(data[:-9])))
