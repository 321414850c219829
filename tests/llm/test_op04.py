import hashlib
import random

from pyspark.sql import functions as F

from cellsheaf.llm.op04_exact_dedup import mark_copies


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def rows():
    rng = random.Random(4)
    base = ["", None, "a", "b" * 300, "b" * 299 + "c", "ü" * 40, "long " * 60_000]
    out = [(i, rng.choice(base)) for i in range(120)]
    out += [(1000 + i, "hot copy") for i in range(400)]
    return out + [(7, "same row"), (7, "same row"), (7, "other text"), (None, "no id"), (None, "a"), (2000, "alone")]


def test_against_brute_force(spark):
    given = rows()
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    for bound in (16 << 20, 0):
        got = mark_copies(docs, bound=bound)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
            [(i, t, *x[1:]) for (i, t), x in zip(given, [one(given, r) for r in given])], key=repr
        )


def one(given, row):
    return next(x for x in brute(given) if x[0] == row[0] and x[4] == hashlib.sha256((row[1] or "").encode()).hexdigest())


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x", 5, "k")], "doc_id long, text string, keep_id int, KEPT string").withColumn("a.b", F.lit(1))
    got = mark_copies(docs)
    assert got.columns == ["doc_id", "text", "a.b", "keep_id", "group_size", "kept", "text_sha256"]
    assert got.first()["kept"] is True
    assert mark_copies(docs.limit(0)).count() == 0
