import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cellsheaf.llm import op13_divergence as op
from cellsheaf.llm.entry import ORACLES, QUERIES
from cellsheaf.llm.op13_divergence import divergence, tree_corrections
from workloads.check import compare

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, documents, ranks):
    held, df, counts = defaultdict(set), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        held[lang].add(source)
        df.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
    out = []
    for lang, sources in held.items():
        kept = [t for (k, t), n in df.items() if k == lang and n >= documents]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def corpus():
    rng = random.Random(13)
    terms = [f"term{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(150)] + ["naïve", "Ünder", "漢字", "don"]
    rows = []
    for k in range(400):
        source = rng.choice(["big"] * 5 + ["s1", "s2", "s3", "s4", None])
        own = terms[: 40 + 10 * (len(source or ""))]
        text = rng.choice([" ", "-", "'t "]).join(rng.choices([*own, *terms[-4:]], k=rng.randint(1, 60)))
        rows.append((text.upper() if k % 7 == 0 else text, rng.choice(["en"] * 4 + ["de", None]), source))
    return rows + rows[:5] + [(None, "en", "s1"), ("", "en", "none"), ("rare words", "xx", "a"), ("", "xx", "b"), ("alone " * 3, "yy", "c"), ("long " * 50_000, "en", "s1"), *[("tie tie", "zz", s) for s in "abcab"]]


@pytest.mark.parametrize("memory, held", [(300_000, 1 << 20), (50, 4)])
def test_against_brute_force(spark, monkeypatch, memory, held):
    monkeypatch.setattr(op, "MEMORY", memory)
    monkeypatch.setattr(op, "HELD", held)
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"n": F.lit(1), "p": F.lit(2), "term": F.lit("x"), "rank": F.lit(0)}).repartition(5)
    got = [tuple(r) for r in divergence(docs, 5, 12).collect()]
    assert sorted(got) == brute(rows, 5, 12)
    assert divergence(docs, 5, 12).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_tree_meets_each_pair_of_a_row_with_its_multiplicity(spark):
    rng = random.Random(31)
    rows = []
    for lang in ("a", "b"):
        zero = [rng.randint(1, 50) for _ in range(5)]
        seen = {}
        for _ in range(60):
            path = tuple((k, n, 7 * n + k, zero[k]) for k in range(5) if (n := rng.randint(0, 2)))
            if path:
                seen[path] = seen.get(path, 0) + rng.randint(1, 9)
        rows += [(lang, list(path), m) for path, m in seen.items()]
    want = Counter()
    for lang, path, m in rows:
        for i, (g, _, p, p0) in enumerate(path):
            for h, _, q, q0 in path[i + 1 :]:
                want[lang, g, h] += m * (abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0))
    paths = spark.createDataFrame(rows, "lang string, path array<struct<rank:long,n:long,p:long,zero:long>>, m long").repartition(4)
    assert {(r["lang"], r["g"], r["h"]): r["value"] for r in tree_corrections(paths).collect()} == dict(want)


def test_empty_table(spark):
    assert divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_query_by_sql(spark):
    diff, rows = compare(spark, "/root/testdata/sf0.01", QUERIES["op13_divergence"], ORACLES["op13_divergence"])
    assert diff is None and rows > 0, diff
