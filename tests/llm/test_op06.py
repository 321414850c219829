import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cellsheaf.llm.op06_near_dedup import components, keep_one, near_classes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(rows):
    """Classes by exact weighted Jaccard similarity of all pairs."""
    bags = [(i, shingles(t)) for i, t in rows]
    df = Counter(s for _, b in bags for s in b)
    total = len(bags)
    idf = {s: 1 + math.log((1 + total) / (1 + n)) / math.log(2 + total) for s, n in df.items()}
    root = {i: i for i, _ in bags}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    close = 0
    for x, (i, a) in enumerate(bags):
        for j, b in bags[:x]:
            shared = sum(min(a[s], b[s]) * idf[s] for s in a if s in b)
            if not shared:
                continue
            full = sum(n * idf[s] for s, n in a.items()) + sum(n * idf[s] for s, n in b.items()) - shared
            close += abs(shared / full - 0.8) < 1e-6
            if shared / full >= 0.8:
                p, q = sorted((top(i), top(j)))
                root[q] = p
    assert not close
    return {i: top(i) for i, _ in bags}


def corpus():
    rng = random.Random(6)
    word = lambda: f"w{rng.randint(0, 4000)}"
    texts = [None, "", "...", "one", "One!", "two words", "a b c d", "A, b; c d", "a b c d e"]
    for size in (30, 80, 200):
        for _ in range(12):
            base = [word() for _ in range(size)]
            for _ in range(rng.randint(1, 5)):
                own = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    own[rng.randrange(size)] = word()
                texts.append(" ".join(own))
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(40)] + passage) for _ in range(30)]
    hot = [word() for _ in range(120)]
    for _ in range(120):
        own = list(hot)
        own[rng.randrange(120)] = word()
        texts.append(" ".join(own))
    return texts + [texts[20]] * 3 + [texts[20].upper() + "!", "very long " * 20_000 + "end"]


def test_against_brute_force(spark):
    rows = list(enumerate(corpus()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash")).repartition(6)
    got = {r["doc_id"]: r for r in near_classes(docs).collect()}
    want = brute(rows)
    assert {i: r["class_id"] for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (i == want[i]) for i, r in got.items())
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_empty_table_nulls_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same words here"), (None, "Same words here"), (1, "same words here"), (None, "alone"), (2, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in near_classes(docs).collect()), key=repr)
    assert got == sorted([(1, 1, 3, True), (None, 1, 3, True), (1, 1, 3, True), (None, None, 1, True), (2, 2, 1, True)], key=repr)
    assert near_classes(docs.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (99, 101)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "star long, member long")).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99, 101: 99}


def test_pairs_in_a_large_bucket_of_several_components(spark):
    """Texts at about 0.75 to each other by a passage they share, and pairs among them just above 0.8."""
    rng = random.Random(66)
    word = lambda: f"u{rng.randint(0, 10**9)}"
    passage = [word() for _ in range(204)]
    tails = [[word() for _ in range(18)] for _ in range(300)]
    for k in range(40):
        tails[299 - k] = tails[20 + k][:7] + tails[299 - k][7:]
    rows = [(7 * i, " ".join(passage + t)) for i, t in enumerate(tails)]
    want = brute(rows)
    assert len(set(want.values())) == 260
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()} == want
