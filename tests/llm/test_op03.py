import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cellsheaf.llm import labelled, op03_toxicity
from cellsheaf.llm import words as W
from cellsheaf.llm.op03_toxicity import FILTERS, LOGIT_STEPS, PARTS, WIDTHS, Classifier, best_threshold, buckets, drop_toxic, fit, flat, labelled_words, packed, parts, score_toxicity, total, unpacked

BAD = ["vile", "rotten", "scum", "faul"]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        body = [f"w{rng.randint(0, 800)}" for _ in range(rng.randint(5, 120))] + (["the", "of"] if i % 2 else ["der", "und"])
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                body.insert(rng.randint(0, len(body)), rng.choice(BAD))
        rng.shuffle(body)
        rows.append((i, " ".join(body), int(toxic)))
    return rows


def test_responses_are_the_convolution():
    texts = ["", "a b c d", "a", "one two", "x y z x y z", "", "last"]
    h, at = W.words(pa.array(texts))
    model = Classifier([h[i:j] for i, j in zip(at, at[1:])], np.array([0, 1, 0, 1, 0, 1, 0]))
    for w in WIDTHS:
        model.bias[w] = np.linspace(-0.2, 0.2, FILTERS).astype(np.float32)
    got = model.responses(h, at)
    for r in range(len(texts)):
        i, j = buckets(h[at[r] : at[r + 1]])
        x = np.vstack([model.embedding[0][i] + model.embedding[1][j], np.zeros((3, model.embedding.shape[2]), np.float32)])
        want = []
        for w in WIDTHS:
            z = [sum(x[p + k] @ model.filters[w][k] for k in range(w)) + model.bias[w] for p in range(len(i))]
            want.append(np.maximum(np.max(z, axis=0), 0) if z else np.zeros(FILTERS))
        assert np.allclose(got[r], np.concatenate(want), atol=1e-5)


def test_thresholds():
    assert best_threshold(np.array([1.0, 2, 5, 6]), np.array([0, 0, 1, 1])) == 3.5
    assert best_threshold(np.array([1.0, 1, 1, 4]), np.array([0, 1, 0, 1])) == 2.5
    assert best_threshold(np.array([1.0]), np.array([1])) == 0


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, 1), (None, 1), (2, None), (99_999, 1)], "doc_id long, toxic int")
    model, thresholds = fit(docs, labels)
    odd = [(5000, None), (5001, ""), (5002, "... !"), (None, "scum rotten vile"), (5003, "w1 " * 100_000 + "scum vile faul"), (5003, "w1"), (5003, "w1")]
    given = [(i, t) for i, t, _ in rows] + odd
    table = spark.createDataFrame(given, "doc_id long, text string").withColumn("SCORE", F.lit("own")).withColumn("lang", F.lit(None).cast("string"))
    got = score_toxicity(table, model, thresholds).collect()
    assert len(got) == len(given) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    want = {i: y for i, _, y in rows}
    out = [r["predicted"] == want[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in want]
    assert len(out) > 100 and np.mean(out) >= 0.97
    by = {r["text"]: r for r in got}
    assert by["scum rotten vile"]["predicted"] == 1 and by[odd[4][1]]["predicted"] == 1 and by[""]["score"] == by[None]["score"] == by["... !"]["score"] < 0.5
    left = drop_toxic(table, labels)
    assert left.columns == table.columns and left.filter("SCORE = 'own'").count() == sum(r["predicted"] == 0 for r in got)


def test_no_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert score_toxicity(docs, *fit(docs, labels)).first()["score"] == 0
    assert score_toxicity(docs.limit(0), *fit(docs.limit(0), labels.limit(0))).count() == 0


def test_packed_words_and_sums_of_parts(spark):
    h, _ = W.words(pa.array(["a b c é x9"]))
    assert all((a == b).all() for a, b in zip(buckets(h), buckets(unpacked(packed(h)))))
    rows = np.random.default_rng(1).integers(-5, 5, (4, 21)) * (np.arange(21) > 9)
    sent = spark.createDataFrame([(k,) for k in range(4)], "k int").repartition(2).mapInArrow(lambda batches: (parts(rows[k]) for b in batches for k in b.column("k").to_pylist()), PARTS)
    assert (total(sent, 21) == rows.sum(axis=0)).all()


def test_every_labelled_row_and_text_is_learnt_from(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(2)), int(i % 70 == 0)) for i in range(9000)] + [(9001, "w1 " * 20_000 + "end", 1), (9003, None, 0), (9003, "w2", 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows}
    want = sorted((i, y, packed(W.words(pa.array([t or ""]))[0]).tobytes()) for i, t, y in rows if fold[i])
    assert sum(y == 0 for _, y, _ in want) > 6000
    for few in (True, False):  # labels broadcast, and dealt with the texts
        for module in (labelled, op03_toxicity):
            monkeypatch.setattr(module, "fits", lambda *a, few=few: few)
        got = labelled_words(docs, labels, "toxic", 1000).collect()
        assert sorted((r["doc_id"], r["y"], bytes(r["words"])) for r in got) == want
        assert all(r["calibrates"] == (fold[r["doc_id"]] == 4) for r in got)
        assert len({(r["doc_id"], r["shard"]) for r in got}) == len({r["doc_id"] for r in got}) and len({r["shard"] for r in got}) > 5


def test_long_texts_train_and_thresholds_are_those_of_all_calibrating_rows(spark):
    rows = [(i, t + " w1" * (4100 if y else 0), y) for i, t, y in corpus(500)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model, thresholds = fit(docs.repartition(5), labels, shard_rows=150)
    again, same = fit(docs.repartition(2), labels, shard_rows=150)
    assert (flat(model._parameters()) == flat(again._parameters())).all() and (thresholds == same).all()
    toxic = np.mean([y for i, _, y in rows if zlib.crc32(str(i).encode()) % 5])
    own = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5 == 4]
    logit = np.rint(model.logits(*W.words(pa.array([t for t, _ in own]))) * LOGIT_STEPS) / LOGIT_STEPS
    assert thresholds[-1] == best_threshold(logit, np.array([y for _, y in own]), np.sqrt(toxic / (1 - toxic)))
    got = score_toxicity(docs, model, thresholds).filter("held_out").select("doc_id", "predicted").collect()
    want = {i: y for i, _, y in rows}
    assert len(got) > 50 and np.mean([r["predicted"] == want[r["doc_id"]] for r in got]) >= 0.97
