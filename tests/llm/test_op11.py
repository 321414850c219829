import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellsheaf.llm import op11_spelling as op
from cellsheaf.llm.op11_spelling import acceptor, composed, near_words, op11_spelling, pieces, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 5 * count[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), count.get(form[w])) for w, n in count.items()}


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcÉéß") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "bababab", "Straße", "STRASSE", "strasse", "naïvely", "naively", "x" * 64, "x" * 65, "y" + "x" * 64]
    for w in list(words):
        for _ in range(3):
            k = rng.randrange(len(w))
            words.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + "q" + w[k + 1 :]]))
    weights = [rng.choice((1, 3, 30, 200)) for _ in words]
    texts = [" ".join(rng.choices(words, weights, k=250)) + rng.choice([". ", "1", "Łata", ""]) for _ in range(80)]
    return [*enumerate(texts), (None, texts[3]), (5, texts[5]), (900, None), (901, ""), (902, "... 12"), (903, "lengthy" * 3000 + " lengthy"), *[(1000 + k, "lengthy" * 3000 + "s") for k in range(5)]]


@pytest.mark.parametrize("group_words", [8192, 20, 1])
def test_against_brute_force(spark, group_words):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(1), "key": F.lit("k")}).repartition(5)
    got = [tuple(r) for r in spelling_variants(docs, group_words).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert max(n_near for *_, n_near, _ in got) > 3 and any(form and form != root for _, form, root, *_ in got)


def test_partial_sums_and_long_texts(spark, monkeypatch):
    assert [w for p in pieces(b"ab cd  ef gh", 4) for w in p] == [b"ab", b"cd", b"ef", b"gh"]
    assert list(pieces(b"abcdefgh", 4)) == [[b"abcdefgh"]] and list(pieces(b"", 4)) == []
    monkeypatch.setattr(op, "MEMORY", 10)
    rows = [(k, "planets planets comets galaxies" + " starlight" * (k % 3)) for k in range(40)]
    got = {(r["word"], r["n"]) for r in op.word_counts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got == {(w, n) for w, _, _, n, _, _ in brute(rows)}


def test_acceptor_is_minimal_and_composition_gives_each_pair_once():
    words = sorted({"".join(random.Random(k).choice("ab") for _ in range(random.Random(-k).randint(0, 7))) for k in range(1, 200)})
    arcs, final = acceptor(words)

    def accepted(state):
        return ({""} if final[state] else set()) | {c + r for c, t in arcs[state].items() for r in accepted(t)}

    languages = [frozenset(accepted(s)) for s in range(len(arcs))]
    assert languages[-1] == set(words) and len(set(languages[:-1])) == len(languages) - 1
    pairs = [frozenset(p) for p in composed(arcs, final)]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert list(composed(*acceptor([]))) == []


def test_words_of_many_positions_meet_once(spark):
    """Words that only keys compare: one prefix for all of them, and words beyond LONG code points."""
    words = ["prefix" + a + b for a in "abcdefgh" for b in ("", *"abcdefgh")] + ["q" * 70, "q" * 71, "q" * 35 + "r" + "q" * 34, "r" + "q" * 69, "q" * 69 + "r"]
    table = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n long")
    got = [(r["word"], r["other"], r["other_n"]) for r in near_words(table, 2).collect()]
    want = {(a, b, words.index(b)) for a in words for b in words if one_edit(a, b)}
    assert len(got) == len(want) and set(got) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(docs).count() == 0


def test_query_over_the_whole_table(spark):
    got = op11_spelling(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert {tuple(r) for r in got.collect()} == brute(rows)
