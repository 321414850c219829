import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cellsheaf.llm.common import shared_folder
from cellsheaf.llm.op07_token_store import END, read_file, read_store, write_store
from cellsheaf.llm.storage import opened
from cellsheaf.llm.tokens import encoded

PATH = public_tokenizers.path("word_bpe_49k.json")


def trip(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(5)
    folder = shared_folder(spark)
    files = write_store(docs, PATH, folder)
    return folder, files, read_store(files, folder, with_ids=True)


def test_round_trip(spark):
    texts = [None, "", "Word word", "Ünï 漢字", "long text, 12 " * 20_000] + [f"doc {i} the of and " * (i % 40) for i in range(300)]
    rows = [(3 * i - 30, t) for i, t in enumerate(texts)] + [(6, "Word word"), (6, "Word word"), (None, "no id")]
    folder, files, out = trip(spark, rows)
    got = sorted(out.collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i)) and len(got) == len(rows)
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    want = sorted((str(i), ids) for (i, _), ids in zip(rows, encoded(PATH, [t for _, t in rows], END)))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["n_tokens"] * 4 == len(r["ids"]) for r in got)
    # One short document by its index entry alone.
    store, _ = opened(folder)
    file = files.orderBy("part").first()
    assert next(read_file(store, file["path"], slice(1, 2)))[1] == got[1]["ids"]
    assert files.agg(F.countDistinct("dictionary")).first()[0] == 1


def test_empty_table_and_broken_file(spark):
    assert trip(spark, [(1, "x")])[2].filter("doc_id = 1").count() == 1
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = shared_folder(spark)
    assert read_store(write_store(docs, PATH, folder), folder).count() == 0
    store, root = opened(folder)
    with store.open_output_stream(f"{root}/bad.tkz") as f:
        f.write(b"x" * 100)
    with pytest.raises(ValueError):
        next(read_file(store, f"{root}/bad.tkz"))
