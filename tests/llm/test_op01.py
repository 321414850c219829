import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cellsheaf.llm.op01_quality import OUTPUT, STATISTICS, Model, described, fit, isotonic, normal_equations, score_quality, statistics


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        body = [f"word{rng.randint(0, 900)}" for _ in range(rng.randint(20, 200))]
        kind = rng.randint(0, 9)
        if kind == 0:
            body = [w.upper() + "!!" for w in body[:15]] * 8
        if kind == 1:
            body = [w for w in body[:12] for _ in range(10)]
        rows.append((i, " ".join(body) + ".", int(kind > 1)))
    return rows


def test_statistics():
    texts = ["", None, "...", "ab AB 12\nab ab|ab AB 12!", "x\ny z\nx\ny z", "é" * 10]
    got = [dict(zip(STATISTICS, row)) for row in statistics(pa.array(texts, pa.string()))]
    assert not any(got[0].values()) and not any(got[1].values())
    assert got[2]["stop"] == 1 and got[2]["log_words"] == 0
    a = got[3]
    assert np.isclose(a["log_words"], np.log(9)) and np.isclose(a["distinct_words"], 2 / 8) and np.isclose(a["top_word"], 6 / 8) and np.isclose(a["adjacent"], 4 / 8)
    assert np.isclose(a["bar"], 1 / 24) and np.isclose(a["upper"], 4 / 24) and np.isclose(a["shout"], 1 / 24) and a["distinct_lines"] == 1
    b = got[4]
    assert np.isclose(b["distinct_lines"], 2 / 4) and np.isclose(b["line_words"], np.log1p(6 / 4))
    assert got[5]["beyond_ascii"] == 1
    alone = np.vstack([statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(alone, statistics(pa.array(texts, pa.string())))


def test_isotonic_is_the_best_rising_fit():
    x, s = isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert np.allclose(s, [0, 0.5, 2 / 3]) and np.allclose(x, [0, 1.5, 4])


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(5)
    stats, y = rng.normal(size=(200, len(STATISTICS))), rng.integers(0, 2, 200)
    model = Model(stats.mean(0), stats.std(0), features=40)
    rows = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<double>, y int").repartition(7)
    a, b = normal_equations(rows, model)
    z, w = model.features(stats), np.where(y == 1, 100 / (y == 1).sum(), 100 / (y == 0).sum())
    assert np.allclose(a, z.T @ (z * w[:, None])) and np.allclose(b, (z * w[:, None]).T @ y)


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    odd = [(5000, None), (5001, ""), (5002, "..."), (None, "a few words"), (5003, "very long text " * 100_000), (5003, "x"), (5003, "x")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string").withColumn("stats", F.lit("own")).repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (4, None), (77_777, 0)], "doc_id long, quality int")
    got = score_quality(docs, labels)
    assert got.columns == ["doc_id", *OUTPUT]
    got = got.collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    want = {i: y for i, _, y in rows}
    hits = [r["predicted"] == want[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in want]
    assert len(hits) > 200 and np.mean(hits) >= 0.98
    assert len({r["score"] for r in got if r["doc_id"] in (5000, 5001)}) == 1


def test_no_rows_or_one_class(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert score_quality(docs, labels).first()["score"] == 0.5
    assert score_quality(docs.limit(0), labels).count() == 0
    assert fit(described(docs.limit(0)), labels.limit(0)) is None
