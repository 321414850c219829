import hashlib
import sys
from pathlib import Path

import public_tokenizers

sys.path.insert(0, str(Path(__file__).parent))

from test_op06 import brute as near  # noqa: E402
from test_op10 import brute as passages  # noqa: E402

from cellsheaf.llm.op03_toxicity import fit, score_toxicity  # noqa: E402
from cellsheaf.llm.tokens import encoded  # noqa: E402
from corpus_pipeline import STAGES, run  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = score_toxicity(docs, *fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    left = {r["doc_id"]: r["text"] for r in scores if not r["predicted"]}
    keep = {}
    for i, t in sorted(left.items()):
        keep[hashlib.sha256((t or "").encode()).hexdigest()] = i
    left = {i: left[i] for i in keep.values()}
    classes = near(sorted(left.items()))
    left = {i: t for i, t in left.items() if classes[i] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i in list(left):
        words, hits, _ = passages(left[i], items)
        if hits and 20 * hits >= words:
            del left[i]
    want = {i: len(ids) // 4 for i, ids in zip(left, encoded(public_tokenizers.path("byte_bpe_50k.json"), left.values(), 1))}
    got = run(spark, SF).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want and 0 < len(want) < docs.count()
    assert sum(r["length"] for r in got) == sum(want.values())


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.schema.names, name
        assert stage(spark, docs, SF).count() == 0, name
