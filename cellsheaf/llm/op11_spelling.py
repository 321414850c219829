"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, acceptor again.

1. One scan counts words; partial sums leave a task, never single occurrences.
2. Two words one edit apart share their first HEAD code points, or their last ones. So the vocabulary is dealt
   twice, as written and reversed, by the state that the acceptor reaches behind a prefix. A prefix of HEAD code points
   that has more than GROUP_WORDS words is cut at one code point more, up to TAIL.
3. In such a group the words become a minimal acyclic acceptor. Composed with the transducer and itself, it
   stays in pairs of equal states up to the edit and then runs through the pairs of states that still accept
   the same rest; rests are found once a state, not once a word.
4. Pairs whose edit lies before the end of the prefix of a group that was cut, and pairs with a word of more than LONG
   code points, meet by keys instead: a word with one position left out. A key has few words, however hot the prefix.
5. Forms and roots follow from counts; roots by doubling, since counts grow fivefold along a chain.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import fits, staged, union_all

SHORTEST, FEWEST, RATIO = 6, 5, 5
#: A run loses a code point where this number divides its hash.
SLIP = 199
#: Code points that words of a group share at least and at most; a shortest word holds two heads.
HEAD, TAIL = 3, 6
GROUP_WORDS = 8192
LONG = 64
#: Words that a task counts before it hands on their sums, and bytes of a text that are cut into words at a time.
MEMORY, PIECE = 300_000, 4 << 20

#: Latin-1 bytes of runs, A-Z lowered; all others become spaces.
_RUNS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def pieces(data: bytes, most: int = PIECE) -> Iterator[list[bytes]]:
    """Words of text whose separators are spaces, a bounded part of a long text at a time."""
    at = 0
    while at < len(data):
        to = data.find(b" ", at + most) if len(data) - at > most else len(data)
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of the vocabulary of documents (doc_id, text)."""

    def summed(total: dict) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def count(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                seed = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                found: Counter = Counter()
                # A character beyond Latin-1 becomes one that no run holds.
                for part in pieces((text.as_py() or "").encode("latin-1", "replace").translate(_RUNS)):
                    found.update(part)
                for run, n in found.items():
                    if len(run) < SHORTEST:
                        continue
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                    if h % SLIP == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < SHORTEST:
                            continue
                    total[run] = total.get(run, 0) + n
                if len(total) > MEMORY:
                    yield summed(total)
                    total = {}
        yield summed(total)

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return found.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


def acceptor(words: list[str]) -> tuple[list[dict[str, int]], list[bool]]:
    """Arcs and finality of the states of the minimal acceptor of sorted distinct words; the last state is the initial one."""
    arcs: list[dict[str, int]] = []
    final: list[bool] = []
    known: dict = {}

    def frozen(out: dict[str, int], ends: bool) -> int:
        state = known.setdefault((ends, *out.items()), len(arcs))
        if state == len(arcs):
            arcs.append(out)
            final.append(ends)
        return state

    path: list[list] = [[{}, False]]
    last = ""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            out, ends = path.pop()
            path[-1][0][last[len(path) - 1]] = frozen(out, ends)

    for word in words:
        shared = next((k for k, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        path += [[{}, False] for _ in word[shared:]]
        path[-1][1] = True
        last = word
    close(0)
    arcs.append(path[0][0])
    final.append(path[0][1])
    return arcs, final


def composed(arcs: list[dict[str, int]], final: list[bool]) -> Iterator[tuple[str, str]]:
    """Every pair of accepted words one edit apart, once; where their lengths differ the longer comes first."""
    alive: dict[tuple[int, int], bool] = {}
    known: dict[int, list[tuple[str, str]]] = {}

    def meet(p: int, q: int) -> bool:
        """Whether two states accept a rest in common."""
        if p == q:
            return True
        key = (p, q) if p < q else (q, p)
        if key not in alive:
            alive[key] = final[p] and final[q] or any(meet(t, arcs[q][c]) for c, t in arcs[p].items() if c in arcs[q])
        return alive[key]

    def rests(p: int, q: int, but: str = "") -> Iterator[str]:
        """Rests that both states accept, but for those that begin with `but`."""
        if final[p] and final[q]:
            yield ""
        for c, t in arcs[p].items():
            if c != but and c in arcs[q] and meet(t, arcs[q][c]):
                for rest in rests(t, arcs[q][c]):
                    yield c + rest

    def edits(state: int) -> list[tuple[str, str]]:
        """Pairs of rests of one state whose first code points are edited: replaced, or one of them deleted."""
        if state not in known:
            out = list(arcs[state].items())
            pairs = [(a + r, b + r) for k, (a, p) in enumerate(out) for b, q in out[:k] if meet(p, q) for r in rests(p, q)]
            known[state] = pairs + [(a + r, r) for a, p in out for r in rests(p, state, a)]
        return known[state]

    todo = [("", len(arcs) - 1)]
    while todo:
        prefix, state = todo.pop()
        for x, y in edits(state):
            yield prefix + x, prefix + y
        todo += [(prefix + c, t) for c, t in arcs[state].items()]


def _depths(words: DataFrame, group_words: int) -> DataFrame:
    """Add depth: the shortest prefix of `key` with at most so many words; null if none up to TAIL is."""
    levels = range(HEAD, TAIL + 1)
    prefixes = words.select(F.explode(F.array(*[F.substring("key", 1, k) for k in levels])).alias("prefix"))
    hot = staged(prefixes.groupBy("prefix").agg(F.count("*").alias("m")).filter(F.col("m") > group_words).drop("m"))
    n = hot.count()
    if not n:
        return words.withColumn("depth", F.lit(HEAD))
    depth = F.lit(None).cast("int")
    for k in reversed(levels):
        own = hot.select(F.col("prefix").alias(f"prefix{k}"), F.lit(True).alias(f"hot{k}"))
        words = words.join(F.broadcast(own) if fits(n, 64) else own, F.substring("key", 1, k) == F.col(f"prefix{k}"), "left").drop(f"prefix{k}")
        depth = F.when(F.col(f"hot{k}").isNull(), k).otherwise(depth)
    return words.withColumn("depth", depth).drop(*[f"hot{k}" for k in levels])


def _keyed_pairs(words: DataFrame) -> DataFrame:
    """Pairs (key, other, other_n) of the words (key, n, depth) that no group compares, by keys with one position left out.

    Keys carry a 128-bit name of the word; its text is looked up again for the few pairs that meet, which are then verified.
    """
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))

    def keys(batches):
        for batch in batches:
            for key, a, b, depth in zip(*(batch.column(c).to_pylist() for c in ("key", "a", "b", "depth"))):
                size = len(key)
                to = size + 1 if depth is None or size >= LONG else depth
                codes = np.frombuffer(key.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
                powers = np.cumprod(np.append(np.uint64(1), np.full(max(size - 1, 0), _BASE, np.uint64)))
                sums = np.append(np.uint64(0), np.cumsum(codes * powers))
                at = np.arange(HEAD, min(to, size))
                left_out = sums[at] + (sums[-1] - sums[at + 1]) * inverse
                # Whole words wait at the positions at which a longer one may have its further code point.
                whole = np.arange(HEAD, min(to, size + 1))
                hashes = np.append(left_out, np.full(len(whole), sums[-1])).view(np.int64)
                rows = len(hashes)
                columns = [np.full(rows, a), np.full(rows, b), np.full(rows, size), np.append(at, whole), hashes]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.arange(rows) < len(at))], names=["a", "b", "size", "at", "hash", "shorter"])

    named = staged(words.withColumns({"a": F.xxhash64(F.lit(1), "key"), "b": F.xxhash64(F.lit(2), "key")}))
    rows = staged(named.mapInArrow(keys, "a long, b long, size long, at long, hash long, shorter boolean"))
    other = rows.select(F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("size").alias("other_size"), "at", "hash", F.col("shorter").alias("other_shorter"))
    met = rows.join(other, ["at", "hash"]).filter(
        # Equal lengths: both leave the position out. Otherwise the longer one does.
        F.when(F.col("size") == F.col("other_size"), F.col("shorter") & F.col("other_shorter") & ((F.col("a") != F.col("oa")) | (F.col("b") != F.col("ob"))))
        .when(F.col("size") == F.col("other_size") + 1, F.col("shorter") & ~F.col("other_shorter"))
        .when(F.col("size") + 1 == F.col("other_size"), ~F.col("shorter") & F.col("other_shorter"))
        .otherwise(False)
    )
    pairs = met.select("a", "b", "oa", "ob", "at").join(named.select("a", "b", "key", "depth"), ["a", "b"])
    pairs = pairs.join(named.select(F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("key").alias("other"), F.col("n").alias("other_n")), ["oa", "ob"])
    at, size, longest = F.col("at"), F.length("key"), F.greatest(F.length("key"), F.length("other"))
    rest = lambda c, whole: F.substring(c, (at + F.when(F.length(c) == whole, 2).otherwise(1)).cast("int"), F.lit(1 << 30))
    exact = F.expr("left(key, int(at)) = left(other, int(at)) AND substring(key, int(at) + 1, 1) <> substring(other, int(at) + 1, 1)") & (rest("key", longest) == rest("other", longest))
    mine = (longest > LONG) | F.coalesce(at < F.col("depth"), F.lit(True))
    return pairs.filter(exact & mine & (F.abs(size - F.length("other")) <= 1)).select("key", "other", "other_n")


def _group_pairs(words: DataFrame, backward: bool) -> DataFrame:
    """word, other, other_n in both orders of the pairs in every group (prefix) of words (key, n), by composition."""

    def compare(group: pa.Table) -> pa.Table:
        count = dict(zip(group.column("key").to_pylist(), group.column("n").to_pylist()))
        pairs = composed(*acceptor(sorted(count)))
        if backward:
            pairs = ((x[::-1], y[::-1]) for x, y in pairs if x[: -HEAD - 1 : -1] != y[: -HEAD - 1 : -1])
            count = {w[::-1]: n for w, n in count.items()}
        both = [p for x, y in pairs for p in ((x, y), (y, x))]
        columns = [[x for x, _ in both], [y for _, y in both], [count[y] for _, y in both]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["word", "other", "other_n"])

    return words.groupBy("prefix").applyInArrow(compare, "word string, other string, other_n long")


def near_words(vocabulary: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, other, other_n: both orders of every pair of words (word, n) that one edit separates."""
    parts = []
    for backward in (False, True):
        turn = F.reverse if backward else F.col
        words = _depths(vocabulary.select(turn("word").alias("key"), "n"), group_words)
        grouped = words.filter((F.length("key") <= LONG) & F.col("depth").isNotNull())
        parts.append(_group_pairs(grouped.withColumn("prefix", F.expr("left(key, depth)")), backward))
        apart = words.filter(F.col("depth").isNull() | (F.col("depth") > HEAD) | (F.length("key") >= LONG))
        if not apart.isEmpty():
            pairs = _keyed_pairs(apart).select(turn("key").alias("word"), turn("other").alias("other"), "other_n")
            parts.append(pairs.filter(F.expr(f"left(word, {HEAD}) <> left(other, {HEAD})")) if backward else pairs)
    return union_all(parts)


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, the last of the chain of forms, of words that have a form."""
    found = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = staged(found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        found = ahead.drop("moved")
        if ahead.filter("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row for each word of the documents: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters, A-Z lowered, of at least SHORTEST code points and FEWEST occurrences; a run whose hash with
    the doc_id is divisible by SLIP loses one code point first. A word's form is its near word of largest count, of equal
    ones the smallest, if it has RATIO times the word's own; its root is the last form of the chain.

    A null text has no words; a null doc_id hashes as empty text. Rows that repeat are counted again. Words of any
    length are compared whole. Other columns are not read. An empty table gives an empty result.
    """
    vocabulary = staged(word_counts(docs))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(vocabulary, group_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    chosen = form_n >= RATIO * F.col("n")
    found = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, F.col("best.form")).alias("form"), F.when(chosen, form_n).alias("form_n")
    )
    found = staged(found)
    return found.join(_roots(found.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
