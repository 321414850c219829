import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from cellsheaf.llm.op08_pii import GENERAL, KINDS, METHOD_KINDS, REMOVE, SUPPORT, WINDOW, base_spans, sanitise, written

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    out = [(m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text or "") if passes(kind, m[0])]
    return sorted(out)


def texts():
    rng = random.Random(8)
    bits = ["a", "b.c", "@", ".", "..", "-", "_", "%", "+", "+1 (456) 555-2186", "4041894974608795", "4041 8949-7460 8795", "255", "256", "0012", "1.2.3.4", "10.0.0.256", " ", "é", "😀", "x@y.z", "\n", "(", ")", "99", "7", "A"]
    out = ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(3000)]
    out += [None, "", "a@b.c_d@e.f", "a@b@c.d", "1.2.3.4.5.6.7.8", "00000000255.1.1.1", "+1" + "2" * 20, "9" * 9000, "1 " * 9000, "a." * 9000 + "@" + "b.c" * 5000, "+1" * 5000, "x" * 50_000 + "@y.z"]
    return out


def test_base_spans_are_those_of_the_patterns(spark):
    rows = list(enumerate(texts()))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["s"] for r in table.select("doc_id", written(base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()}
    for i, t in rows:
        want = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in brute(t))
        assert (got[i] or "") == want, repr(t)[:200]


def method(rows):
    """(entity, term) -> disclosure, from all distinct texts."""
    distinct = {t or "" for t in rows}
    near, held = defaultdict(set), defaultdict(set)
    for t in distinct:
        for w in WORD.findall(t.lower()):
            if len(w) >= 3:
                held[w].add(t)
        for s, k, e in brute(t):
            before, after = t[max(0, s - WINDOW) : s], t[e : e + WINDOW]
            before = re.sub("^" + WORD.pattern, "", before) if s > WINDOW else before
            after = re.sub(WORD.pattern + r"\Z", "", after) if len(after) == WINDOW else after
            for w in WORD.findall((before + " " + after).lower()):
                if len(w) >= 3:
                    near[f"{k}:{t[s:e].lower()}", w].add(t)
    entities = defaultdict(set)
    for t in distinct:
        for s, k, e in brute(t):
            entities[f"{k}:{t[s:e].lower()}"].add(t)
    n = len(distinct)
    out = {}
    for (entity, w), both in near.items():
        if len(both) >= SUPPORT and len(entities[entity]) < n:
            d = math.log(len(both) * n / (len(entities[entity]) * len(held[w]))) / math.log(n / len(entities[entity]))
            if d >= GENERAL:
                out[entity, w] = d
    return out


def test_terms_that_give_entities_away(spark):
    rng = random.Random(88)
    rows = []
    for i in range(160):
        words = [f"word{rng.randint(0, 60)}" for _ in range(40)]
        if i % 4 == 0:
            person = i // 4 % 5
            at = rng.randint(2, 38)
            words[at:at] = [f"nick{person}", f"p{person}@mail.example", "Nähe" if person == 1 else "x"]
            if i % 8 == 0:
                words.append(f"NICK{person},")
        rows.append(" ".join(words))
    rows += [rows[0], rows[0], None, "", "only p9@mail.example here once"]
    shown = method(rows)
    assert len(shown) >= 5 and any(w == "nähe" for _, w in shown)
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("SPANS", F.lit(1)).withColumns({"md5": F.lit("own"), "removed": F.lit("own"), "n": F.lit(7)}).repartition(4)
    for bound in (16 << 20, 0):
        got = {r["doc_id"]: r for r in sanitise(table, bound=bound).collect()}
        assert len(got) == len(rows) and {(r["md5"], r["removed"], r["n"]) for r in got.values()} == {("own", "own", 7)}
        for i, t in enumerate(rows):
            base = brute(t)
            owned = {}
            for s, k, e in base:
                for (entity, w), d in shown.items():
                    if entity == f"{k}:{t[s:e].lower()}":
                        owned[w] = max(d, owned.get(w, 0))
            more = [(m.start(), 4 if owned[m[0]] >= REMOVE else 5, m.end()) for m in WORD.finditer((t or "").lower()) if m[0] in owned]
            more = [x for x in more if not any(x[0] < e and s < x[2] for s, _, e in base)]
            assert [(s["start"], s["rank"], s["end"]) for s in got[i]["spans"]] == sorted(base + more), t
            clean, at = "", 0
            for s, k, e in sorted(base + more):
                clean += (t or "")[at:s] + ([f"[{x.upper()}]" for x in KINDS] + ["", "[TERM]"])[k]
                at = e
            assert got[i]["clean_text"] == clean + (t or "")[at:]
    assert sanitise(table.limit(0)).count() == 0


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0") and len(METHOD_KINDS) == 2


def test_texts_with_a_capital_dotted_i(spark):
    rows = [f"\u0130stanbul filler{i} nickname q@mail.example" for i in range(4)] + [f"other{i} text" for i in range(40)]
    got = sanitise(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).filter("doc_id < 4").collect()
    assert len(got) == 4
    for r in got:
        assert r["clean_text"].split() == [f"filler{r['doc_id']}", "[EMAIL]"], r["clean_text"]


def test_terms_in_texts_without_the_entity(spark):
    """A nickname and a name of two characters, near an address in most of the texts that hold them."""
    rows = [f"nickname jo q@mail.example text{i}" for i in range(10)] + [f"about nickname and jo {i}x" for i in range(3)] + [f"other{i} words" for i in range(400)]
    for bound in (16 << 20, 0):
        got = {r["doc_id"]: r["clean_text"].split() for r in sanitise(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), bound=bound).collect()}
        assert all(got[i] == ["[TERM]", "[TERM]", "[EMAIL]", f"text{i}"] for i in range(10))
        assert all(got[10 + i] == ["about", "[TERM]", "and", "[TERM]", f"{i}x"] for i in range(3))
