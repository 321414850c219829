import random
import re

from pyspark.sql import functions as F

from cellsheaf.llm.op10_decontaminate import drop_contaminated, find_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        m = min(window, len(w))
        for p in range(len(w) - m + 1 if m else 0):
            for q in range(len(own) - m + 1):
                if own[q : q + m] == w[p : p + m]:
                    hit |= set(range(q, q + m))
                    found.add(str(item) if item is not None else "")
    return len(own), len(hit), sorted(found)


def test_against_brute_force(spark):
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ümlaut", "x"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 14, 20, 40])))) for i in range(12)]
    items += [(12, None), (3, "an id twice but another text " * 3), (None, " ".join(rng.choices(vocabulary, k=15)))]
    texts = [None, "", "...", "w1", "W1-w2"]
    for _ in range(60):
        body = rng.choices(vocabulary + ["other"], k=rng.randint(1, 80))
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            i = rng.randint(0, len(body))
            lo = rng.randint(0, len(w))
            body[i:i] = [x.upper() if x.isascii() else x for x in w[lo : lo + rng.randint(5, 40)]]
        texts.append(rng.choice([" ", "-", "\n"]).join(body))
    texts.append(("filler " * 30_000) + texts[10] + " é" * 10)
    texts += texts[8:12]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (8 << 20, 300):
        got = {r["doc_id"]: r for r in find_passages(docs, bench, block_bytes=size).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute(t, items), (i, t)
            own = words(t)
            for m in got[i]["matches"]:
                want = [" ".join(words(x)) for j, x in items if ("" if j is None else str(j)) == m["item_id"]]
                assert any(" ".join(own[m["start"] : m["start"] + m["words"]]) in x for x in want)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 7)], "doc_id long, text string, n_hit int").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert drop_contaminated(docs, bench).count() == 0
    kept = drop_contaminated(docs, bench.limit(0))
    assert kept.columns == docs.columns and kept.first() == (1, "a b c", 7, "x")
    assert drop_contaminated(docs.limit(0), bench).count() == 0
