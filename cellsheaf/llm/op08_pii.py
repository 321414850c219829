"""Personal data: patterns for the protected values, and an information-theoretic measure for the words that give them away.

A protected entity is a value of one of the base kinds. Over all distinct texts, p(e), p(t) and p(e,t)
are the shares that hold the entity, hold the term, and hold the term within WINDOW
characters of the entity. The disclosure of e by t is PMI(e;t) / IC(e), the part of the entity's information
log 1/p(e) that the term gives away. Terms at GENERAL or more are generalised and at REMOVE or
more removed, wherever they stand, in texts without the entity too. Copies of a text
count once, or copying alone would make every neighbour of an entity look like its sign; a pair counts from SUPPORT texts on.

All of it is DataFrame functions. The work over all texts is one scan for the entities, one for the counts of
candidate terms and one for the result; mentions, terms and counts are shuffled, texts are not as long as the terms
by text are few enough to be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import BROADCAST_BYTES, fits, join_groups, staged, text_of, without

WINDOW, SUPPORT, GENERAL, REMOVE = 80, 2, 0.8, 0.95
KINDS = ("email", "ip", "card", "phone")
METHOD_KINDS = ("removed", "general")
#: The base patterns of the contract in linear time: a run of characters is tried from its start (or from the end of the
#: match before) only, since every later start in it fails or succeeds alike, and nothing in it is tried twice.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without these hold no match.
GUARDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OUTPUT = ["spans", "clean_text"]
_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _small_part(part: Column) -> Column:
    digits = F.regexp_replace(part, "^0+", "")
    return (F.length(digits) < 3) | ((F.length(digits) == 3) & (digits <= "255"))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), _small_part),
    "card": lambda m: F.when(F.length(_digits(m)).between(14, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}


def matches(text: Column, rank: int | Callable[[Column], Column], pattern: str | Column, check: Callable[[Column], Column]) -> Column:
    """Spans of the leftmost non-overlapping matches that pass the check, from the lengths of what lies between them."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda p, m: F.struct(p.alias("gap"), m.alias("match")))
    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        kind = rank(x["match"]) if callable(rank) else F.lit(rank)
        own = F.array(F.struct(start.alias("start"), kind.alias("rank"), end.alias("end"), x["match"].alias("value")))
        passed = x["match"].isNotNull() & check(x["match"])
        return F.struct(end.alias("at"), F.when(passed, F.concat(acc["out"], own)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, first, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """All base spans, by start and then by kind; null if there is none."""
    none = F.expr(f"cast(array() as {_SPAN})")
    lists = []
    for rank, kind in enumerate(KINDS):
        may = F.contains(text, F.lit(GUARDS[kind])) if GUARDS[kind] else F.lit(True)
        # A cheap search first: the spans are worked out for the few texts that have any.
        may = may & text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}" if kind == "card" else PATTERNS[kind])
        lists.append(F.when(may, matches(text, rank, PATTERNS[kind], CHECKS[kind])).otherwise(none))
    every = F.array_sort(F.concat(*lists))
    return F.when(F.size(every) > 0, every)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, *METHOD_KINDS)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def folded(text: Column) -> Column:
    """In lower case at its own length: the capital dotted I is the one character whose lower case has two."""
    return F.lower(F.translate(text, "\u0130", "i"))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(folded(text), F.lit(WORD), F.lit(0))


def mentions(docs: DataFrame) -> DataFrame:
    """Distinct texts with base spans (__text): md5, entity, and the whole words within WINDOW characters of it."""
    rows = docs.select("__text").filter(F.col("__text").rlike("[0-9]|@")).withColumn("spans", base_spans(F.col("__text"))).filter("spans is not null")
    each = rows.select(F.md5(F.col("__text").cast("binary")).alias("md5"), "__text", F.explode("spans").alias("s"))
    begin = F.greatest(F.col("s.start") - WINDOW, F.lit(0))
    before = F.substring("__text", begin + 1, F.col("s.start") - begin)
    after = F.substring("__text", F.col("s.end") + 1, F.lit(WINDOW))
    # Characters at the far ends that belong to a longer word are left out.
    before = F.when(begin > 0, F.regexp_replace(before, f"^{WORD}", "")).otherwise(before)
    after = F.when(F.length(after) == WINDOW, F.regexp_replace(after, f"{WORD}$", "")).otherwise(after)
    entity = F.concat_ws(":", F.col("s.rank"), F.lower("s.value"))
    return staged(each.select("md5", entity.alias("entity"), F.array_distinct(F.concat(_words(before), _words(after))).alias("near")).groupBy("md5", "entity").agg(F.array_distinct(F.flatten(F.collect_set("near"))).alias("near")))


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """entity, term and disclosure (GENERAL or more) of the pairs that at least SUPPORT distinct texts hold."""
    h = F.xxhash64("__text").alias("h")
    copies = docs.select(h).groupBy("h").agg(F.count("*").alias("n"))
    total = copies.count()
    entities = found.groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= SUPPORT)
    pairs = staged(found.select("entity", F.explode("near").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= SUPPORT))
    terms = staged(pairs.select("term").distinct())
    # Each of n copies of a text counts 1/n, so a text counts 1; sums by term are made before the shuffle.
    shared = staged(copies.filter("n > 1"))
    weighted = join_groups(docs.select(h, "__text"), shared, ["h"], "n", docs.count(), 32)
    held = weighted.select((1 / F.coalesce("n", F.lit(1))).alias("w"), F.explode(F.array_distinct(_words(F.col("__text")))).alias("term"))
    if fits(terms.count(), 60):
        held = held.join(F.broadcast(terms), "term", "left_semi")
    counts = held.groupBy("term").agg(F.round(F.sum("w")).alias("n_t"))
    # An entity that all texts hold has no information to give away.
    n = F.lit(float(max(total, 1)))
    share = F.try_divide(F.log(F.col("n_et") * n / (F.col("n_e") * F.col("n_t"))), F.log(n / F.col("n_e")))
    return staged(pairs.join(counts, "term").join(entities, "entity").select("entity", "term", share.alias("disclosure")).filter(F.col("disclosure") >= GENERAL))


def terms_by_text(docs: DataFrame, shown: DataFrame) -> DataFrame:
    """md5 of each text that holds terms which give an entity away, and those terms, to remove and to generalise."""
    terms = staged(shown.groupBy("term").agg(F.max("disclosure").alias("d")))
    held = docs.select(F.md5(F.col("__text").cast("binary")).alias("md5"), F.explode(F.array_distinct(_words(F.col("__text")))).alias("term"))
    own = held.join(F.broadcast(terms) if fits(terms.count(), 60) else terms, "term")
    removed = F.sort_array(F.collect_set(F.when(F.col("d") >= REMOVE, F.col("term"))))
    general = F.sort_array(F.collect_set(F.when(F.col("d") < REMOVE, F.col("term"))))
    return staged(own.groupBy("md5").agg(removed.alias("removed"), general.alias("general")))


def _term_spans(text: Column, removed: Column, general: Column) -> Column:
    terms = F.concat(removed, general)
    inside = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    pattern = F.concat(F.lit(f"(?<!{inside})(?:"), F.array_join(terms, "|"), F.lit(f")(?!{inside})"))
    rank = lambda m: F.when(F.array_contains(removed, m), 4).otherwise(5)
    return F.when(F.size(terms) > 0, matches(folded(text), rank, pattern, lambda m: F.lit(True))).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def cleaned(text: Column, spans: Column) -> Column:
    """The text with base values replaced by their kind, generalised terms by [TERM], and removed terms left out."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS], F.lit(""), F.lit("[TERM]"))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        # A span that starts within the one before only ends later.
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.get(marks, s["rank"])).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    return F.aggregate(spans, first, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, text_col: str = "text", bound: int = BROADCAST_BYTES) -> DataFrame:
    """Add spans (start, rank in KINDS and METHOD_KINDS, end, value; by start and rank) and clean_text to each document.

    Offsets count code points, the end is exclusive. A null or empty text has no spans. Spans of terms that
    overlap a base span are left out.
    Rows may repeat, ids may be null; input columns named like an output are replaced.
    """
    docs = without(docs, OUTPUT).withColumn("__text", text_of(text_col))
    md5 = F.md5(F.col("__text").cast("binary")).alias("__md5")
    found = mentions(docs)
    terms = terms_by_text(docs, disclosures(docs, found))
    terms = terms.select(F.col("md5").alias("__md5"), F.col("removed").alias("__removed"), F.col("general").alias("__general"))
    if fits(terms.count(), 400, bound):
        groups = terms.withColumn("__n", F.lit(1).cast("long"))
    else:
        copies = docs.select(md5).join(terms.select("__md5"), "__md5", "left_semi").groupBy("__md5").agg(F.count("*").alias("__n"))
        groups = staged(terms.join(copies, "__md5"))
    met = join_groups(docs.withColumn("__md5", md5), groups, ["__md5"], "__n", docs.count(), 400, bound)
    text = F.col("__text")
    base = F.coalesce(base_spans(text), F.expr(f"cast(array() as {_SPAN})"))
    met = met.withColumn("__base", base)
    own = F.when(F.col("__removed").isNotNull(), _term_spans(text, F.col("__removed"), F.col("__general"))).otherwise(F.expr(f"cast(array() as {_SPAN})"))
    apart_ = F.filter(own, lambda s: ~F.exists(F.col("__base"), lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    met = met.withColumn("spans", F.array_sort(F.concat("__base", apart_)))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns if c != "__text"], "spans", cleaned(text, F.col("spans")).alias("clean_text"))


def op8_pii(spark, sf_dir: str) -> DataFrame:
    out = sanitise(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    return out.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
