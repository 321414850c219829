import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellsheaf.llm import words as W
from cellsheaf.llm.op05_licence import FAMILIES, NOTICES, altered, fit, grams, paragraphs, scan, units


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 500)}" for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    return fit(spark.createDataFrame([(i, prose(rng, 30) + "\n" + prose(rng, 20)) for i in range(300)], "doc_id long, text string"))


def test_grams_and_units():
    h, part, at, lines = paragraphs(pa.array(["a b c\nd e", None, "f\n\n" + "x " * 200]))
    assert at.tolist() == [0, 5, 5, 206] and part.tolist()[:6] == [0, 0, 0, 1, 1, 2] and lines.tolist() == [0, 2, 2, 5]
    one, two, three = grams(h, part)
    assert [len(g[1]) for g in (one, two, three)] == [206, 206 - 4, 1 + 198]
    assert set(three[1].tolist()) & {0, 1, 2, 3, 4, 5} == {0}
    begin, end = units(part)
    covered = np.zeros(206, bool)
    for b, e in zip(begin, end):
        assert 0 < e - b <= 32 and len(set(part[b:e])) == 1
        covered[b:e] = True
    assert covered.all()


def test_held_out_notices_and_other_text(model):
    rng = random.Random(2)
    filler = prose(rng, 500).split()
    hits = total = 0
    for k, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            for _ in range(10):
                h, at = W.words(pa.array([altered(rng, notice, filler)]))
                p = model.probabilities(h, np.zeros(len(h), int), at[:-1], at[1:])[0]
                hits, total = hits + (p.argmax() == k), total + 1
    assert hits / total > 0.9


def test_documents(spark, model):
    rng = random.Random(3)
    mit, gpl = NOTICES["mit"][0], NOTICES["gpl"][0]
    texts = [
        None, "", "...", mit, f"{prose(rng, 40)}\n{gpl}\n{prose(rng, 10)}\n{mit.upper()}", prose(rng, 100), f"{prose(rng, 150)} {gpl} {prose(rng, 150)}",
        "This work is licensed under the Unheard License, version 9.", "the version of rights", f"{prose(rng, 100)}\n" * 2000 + mit,
    ]
    docs = spark.createDataFrame([*enumerate(texts), (3, mit), (None, mit)], "doc_id long, text string").withColumn("licences", F.lit("own"))
    rows = scan(docs, model).collect()
    got = {r["doc_id"]: [(x["paragraph"], x["family"]) for x in r["licences"]] for r in rows}
    assert len(rows) == len(texts) + 2
    assert got[0] == got[1] == got[2] == got[5] == got[8] == []
    assert got[3] == got[None] == [(0, "mit")] and got[4] == [(1, "gpl"), (3, "mit")] and got[6] == [(0, "gpl")] and got[7] == [(0, "unknown")] and got[9] == [(2000, "mit")]
    assert scan(docs.limit(0), fit(docs.limit(0))).count() == 0
