import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellsheaf.llm import op12_embeddings as op
from cellsheaf.llm.entry import ORACLES, QUERIES
from cellsheaf.llm.op12_embeddings import least_count, near_vectors, signs_of, tables_of
from workloads.check import compare


def brute(rows, threshold=0.98):
    """(n_links, component_id) of each row by all pairs."""

    def usable(row):
        i, x, label = row
        return i is not None and label is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x)

    good = [usable(r) for r in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if not (good[a] and good[b]) or rows[a][2] != rows[b][2] or len(rows[a][1]) != len(rows[b][1]):
                continue
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, links[k], least.get(top(k)) if i is not None else None) for k, (i, _, _) in enumerate(rows)), key=repr)


def vectors():
    rng = np.random.default_rng(12)
    rows = []
    for k in range(40):
        base = rng.standard_normal(24)
        for _ in range(rng.integers(1, 8)):
            own = base + rng.standard_normal(24) * rng.choice([0.02, 0.12, 0.15, 0.2])
            rows.append(((own * rng.choice([1, 1e-3, 50])).astype(np.float32).tolist(), k % 3))
    hot = rng.standard_normal(24)
    rows += [((hot + rng.standard_normal(24) * 0.1).astype(np.float32).tolist(), 0) for _ in range(90)]
    rows += [rows[0]] * 5 + [rows[30]] * 3 + [(rows[0][0], 1), (rows[0][0], None)]
    rows += [(None, 0), ([], 0), ([0.0] * 24, 0), ([0.0] * 24, 0), ([math.nan] + [1.0] * 23, 1), ([math.inf] * 24, 1), ([None] + [1.0] * 23, 1), ([1e38] * 24, 1), ([1e38] * 24, 1), ([1.0] * 3, 1)]
    return [(7 * k, *r) for k, r in enumerate(rows)] + [(None, rows[0][0], 0), (7, rows[1][0], rows[1][1])]


@pytest.mark.parametrize("cell, widest", [(1024, 65_535), (8, 65_535), (32, 16)])
def test_against_brute_force(spark, monkeypatch, cell, widest):
    """One cell a label, cells by several signs, and cells cut into blocks."""
    monkeypatch.setattr(op, "CELL", cell)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"rep": F.lit(1), "m": F.lit("x"), "kept": F.lit("old")}).repartition(5)
    found = near_vectors(table, widest=widest)
    assert found.columns == ["vec_id", "embedding", "label", "rep", "m", *op.OUTPUT]
    got = found.collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_doubles_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [0.99, 0.1], "a"), (3, [0.0, 1.0], "a")]
    schema = "vec_id long, embedding array<double>, label string"
    assert sorted(tuple(r)[3:5] for r in near_vectors(spark.createDataFrame(rows, schema)).collect()) == [(0, 3), (1, 1), (1, 1)]
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_calibration():
    """Signs and windows miss a pair at the threshold as rarely as they promise, and a far pair often."""
    assert signs_of(1024) == 0 and signs_of(1025) == 1 and tables_of(0, 0.98) == 1
    k = signs_of(50_000)
    assert (1 - (1 - math.acos(0.98) / math.pi) ** k) ** tables_of(k, 0.98) <= op.MISS
    rng = np.random.default_rng(1)
    x = op.unit(rng.standard_normal((20_000, 64)))
    off = rng.standard_normal((20_000, 64))
    off = op.unit(off - (off * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * off
    draws = op.directions(64)[1]
    reach = op.REACH * math.sqrt(0.04) / 8
    assert ((np.abs((x - y) @ draws) <= reach).sum(1) >= least_count()).all()
    far = (np.abs((x - off) @ draws) <= reach).sum(1) >= least_count()
    assert far.mean() < 0.05
    shared = [np.any(op.keys_of(x, k, tables_of(k, 0.98), op.directions(64)[0]) == op.keys_of(y, k, tables_of(k, 0.98), op.directions(64)[0]), axis=1)]
    assert np.all(shared)


def test_collisions_are_those_of_all_windows():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((70, 16)), rng.standard_normal((90, 16))
    got = {(i, j) for _, _, i, j in op.collisions(a, b, 0.8, 8) for i, j in zip(i.tolist(), j.tolist())}
    assert got == {(i, j) for i in range(70) for j in range(90) if (np.abs(a[i] - b[j]) <= 0.8).sum() >= 8}


def test_query_by_sql(spark):
    diff, rows = compare(spark, "/root/testdata/sf0.01", QUERIES["op12_embeddings"], ORACLES["op12_embeddings"])
    assert diff is None and rows > 0, diff
