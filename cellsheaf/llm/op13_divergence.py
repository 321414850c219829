"""How far the sources of a language differ in their words, summed over a frequent-pattern tree of term rows.

1. One scan counts terms by language and source, and the documents that hold them; partial sums leave a task.
2. A kept term is a row: its nonzero counts in order of the sources. Equal rows are one with a multiplicity.
3. With p(0) of both sources in all terms, the sum of |p - q| over all kept terms is known. Each source's nonzero counts
   correct it against every p(0) of another (from the counts' histogram), and terms in which both counts are nonzero
   correct it once more: |p-q| - |p-q0| - |p0-q| + |p0-q0|. These come from the tree: rows that share a path share its nodes,
   and each node meets each of its ancestors once, with the multiplicity of all rows below it.
4. Rows are dealt to tasks by ranges of paths and come sorted, so a task holds one path of its tree: a node is whole when
   the next row leaves it.

Rows are as wide as the language has sources; what grows with pairs of sources is only the result asked for.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsheaf.llm import words as W
from cellsheaf.llm.common import fits, staged, union_all
from cellsheaf.llm.op11_spelling import MEMORY, pieces

DOCUMENTS, RANKS = 30, 50
PARTS, PRIOR = 1_000_000_000, 5
#: Pairs of sources whose sums a task holds.
HELD = 1 << 20

#: Bytes of terms, A-Z lowered; all others become spaces. Every byte beyond ASCII belongs to a term.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and df (rows that hold it) of documents (lang, source, text), none of them null."""

    def summed(found: dict) -> pa.RecordBatch:
        rows = [(*group, term, c, df[term]) for group, (n, df) in found.items() for term, c in n.items()]
        lang, source, term, n, df = zip(*rows) if rows else [()] * 5
        terms = pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), terms, pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"]
        )

    def count(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            data, at = W.raw(batch.column("text"))
            data = memoryview(data)
            for k, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                n, df = found.setdefault(group, (Counter(), Counter()))
                before = len(n)
                own: set = set()
                for part in pieces(bytes(data[at[k] : at[k + 1]]).translate(_TERMS)):
                    n.update(part)
                    own.update(part)
                df.update(own)
                held += len(n) - before
                if held > MEMORY:
                    yield summed(found)
                    found, held = {}, 0
        yield summed(found)

    partial = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, df long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (n + PRIOR) / (total + PRIOR * terms)), exactly; null without terms."""
    part = F.lit(PARTS).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", part, (total + PRIOR * terms).cast("decimal(20,0)")))


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if fits(df.count(), row_bytes) else df


def tree_corrections(paths: DataFrame) -> DataFrame:
    """lang, g, h, value: sums over node and ancestor of rows (lang, path of (rank, n, p, zero), m), in ranges of paths."""
    tidy = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")

    def walk(batches):
        lang, depth, size = None, 0, 64
        rank, p, zero, mult = (np.zeros(size, np.int64) for _ in range(4))
        count: list[int] = []
        keys: list[np.ndarray] = []
        values: list[np.ndarray] = []
        held = 0

        def leave(to: int) -> None:
            """Nodes below depth `to` are whole: each meets its ancestors and hands its rows on to its parent."""
            nonlocal depth, held
            while depth > to:
                depth -= 1
                k = depth
                if k:
                    apart = abs(p[k] - p[:k]) - abs(p[k] - zero[:k]) - abs(zero[k] - p[:k]) + abs(zero[k] - zero[:k])
                    keys.append((rank[:k] << 32) | rank[k])
                    values.append(apart * mult[k])
                    mult[k - 1] += mult[k]
                    held += k
                count.pop()

        def summed(out: bool):
            """Add up what is held; all of it leaves the task at the end of a language or if the pairs are too many."""
            nonlocal held
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            value = np.zeros(len(key), np.int64)
            np.add.at(value, place, np.concatenate(values))
            keys.clear()
            values.clear()
            if not out and len(key) <= HELD // 2:
                keys.append(key)
                values.append(value)
                held = len(key)
                return None
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(value)], names=["lang", "g", "h", "value"])

        for batch in batches:
            column = batch.column("path")
            flat, ends = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
            ranks, ns, ps, zeros = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rank", "n", "p", "zero"))
            for row, (own, m) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("m").to_pylist())):
                if own != lang:
                    leave(0)
                    if keys:
                        yield summed(True)
                    lang = own
                at, to = ends[row], ends[row + 1]
                shared = 0
                while shared < depth and at + shared < to and rank[shared] == ranks[at + shared] and count[shared] == ns[at + shared]:
                    shared += 1
                leave(shared)
                while size < to - at:
                    size *= 2
                    rank, p, zero, mult = (np.concatenate([x, np.zeros(size // 2, np.int64)]) for x in (rank, p, zero, mult))
                new = slice(at + shared, to)
                rank[shared : to - at], p[shared : to - at], zero[shared : to - at] = ranks[new], ps[new], zeros[new]
                mult[shared : to - at] = 0
                count += ns[new].tolist()
                depth = int(to - at)
                mult[depth - 1] += m
                if held > HELD and (out := summed(False)) is not None:
                    yield out
        leave(0)
        if keys:
            yield summed(True)

    return tidy.mapInArrow(walk, "lang string, g long, h long, value long").groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, documents: int = DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: how far sources differ (part `pair`) and their own terms (part `term`).

    Part `pair` has a row for each other source of the language, with the sum of |p - q| over its kept terms, those in at least
    `documents` of its rows; part `term` has the first `ranks` terms that a source uses more than its language does.
    Null text, lang and source count as ''. Every row is a document, also where rows repeat an id. Only these
    three columns are read. A language of one source has no pairs, one without kept terms pairs of value 0. Ties go by
    the bytes of the item. An empty table gives an empty result.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = term_counts(docs)
    items = F.collect_list(F.struct("source", "n")).alias("items")
    rows = staged(counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), items).filter(F.col("df") >= documents))
    langs = staged(rows.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total")))
    sums = rows.select("lang", F.explode("items").alias("i")).groupBy("lang", "i.source").agg(F.sum("i.n").alias("size"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(_small(langs, 60), "lang", "left")
    size, v = F.coalesce("size", F.lit(0).cast("long")), F.coalesce("v", F.lit(0).cast("long"))
    # Small counts come first: they are shared by more rows.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(size, "source")).cast("long")
    groups = staged(groups.select("lang", "source", size.alias("size"), v.alias("v"), F.col("total"), rank.alias("rank")).withColumn("zero", _share(F.lit(0), F.col("size"), F.col("v"))))
    own = _small(groups.select("lang", "source", "size", "v", "total", "rank", "zero"), 120)
    cells = rows.select("lang", "term", F.col("n").alias("lang_n"), F.explode("items").alias("i")).select("lang", "term", "lang_n", "i.*").join(own, ["lang", "source"])
    cells = cells.select("lang", "source", "term", "n", "rank", "zero", _share(F.col("n"), F.col("size"), F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("total"), F.col("v")).alias("q"))
    cells = staged(cells)

    path = F.sort_array(F.collect_list(F.struct("rank", "n", "p", "zero"))).alias("path")
    paths = cells.groupBy("lang", "term").agg(path).groupBy("lang", "path").agg(F.count("*").alias("m"))
    both = tree_corrections(paths)
    histogram = cells.groupBy("lang", F.col("rank").alias("g"), "p", "zero").agg(F.count("*").alias("m"))
    others = _small(groups.select("lang", F.col("rank").alias("h"), F.col("zero").alias("h_zero")), 40)
    alone = histogram.join(others, "lang").filter("g <> h").groupBy("lang", "g", "h")
    alone = alone.agg(F.sum(F.col("m") * (F.abs(F.col("p") - F.col("h_zero")) - F.abs(F.col("zero") - F.col("h_zero")))).alias("value"))
    # Every row of both sources, as (g, h) and (h, g).
    base = groups.select("lang", F.col("rank").alias("g"), "zero", "v").join(others, "lang").filter("g <> h")
    base = base.select("lang", "g", "h", F.coalesce(F.col("v") * F.abs(F.col("zero") - F.col("h_zero")), F.lit(0).cast("long")).alias("value"))
    turned = [t.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value") for t in (alone, both)]
    sums = union_all([base, alone, both, *turned]).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    names = lambda key, name: _small(groups.select("lang", F.col("rank").alias(key), F.col("source").alias(name)), 80)
    pairs = sums.join(names("g", "source"), ["lang", "g"]).join(names("h", "item"), ["lang", "h"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))

    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks))


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
), k AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30
), g AS (SELECT DISTINCT lang, source FROM d), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT AS p,
    sum(n) OVER (PARTITION BY lang, term) AS lang_n, sum(n) OVER (PARTITION BY lang) AS lang_total, v
  FROM f JOIN v USING (lang)
), q AS (SELECT *, 1 + (1000000000 * (lang_n + 5)::HUGEINT) // (lang_total + 5 * v)::HUGEINT AS q FROM p
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM q WHERE n > 0 AND p > q
), o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 50
"""
