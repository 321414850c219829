"""Benchmark decontamination with suffix arrays over the training text.

Every slice of a partition is a shard. Its words become numbers of the benchmark's vocabulary
(0 for any other word, which so ends a match), and its suffixes are sorted by their first
WINDOW words: the suffix array of the shard. Each test suffix is looked up in it by binary search;
the interval found holds all its verbatim locations, and neighbouring locations on one diagonal make up
the longest matches. A suffix that meets a foreign word before the shortest window is over can't hold
a match and is left out of the array. Texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf.llm import words as W
from cellsheaf.llm.common import apart, staged, without

WINDOW = 13
#: The benchmark is looked up in blocks of about so many bytes of text.
BLOCK_BYTES = 8 << 20
OUTPUT = ["n_words", "n_hit", "items", "matches", "hit_bits"]
MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("words", pa.int64())]))


class Block:
    """Test suffixes that are long enough for a window, as numbers of the words, sorted and distinct."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        h, at = W.words(texts)
        self.ids = np.array(ids, object)
        self.vocabulary = np.unique(h)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        number = np.searchsorted(self.vocabulary, h) + 1
        count = np.diff(at)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        own = np.minimum(count, window)
        starts = np.maximum(count - own + 1, 0) * (count > 0)
        item = np.repeat(np.arange(len(count)), starts)
        inner = np.arange(len(item)) - np.repeat(np.cumsum(starts) - starts, starts)
        length = own[item]
        grid = (at[item] + inner)[:, None] + np.arange(window)
        inside = np.arange(window) < length[:, None]
        table = np.where(inside, number[np.minimum(grid, max(len(number) - 1, 0))] if len(number) else 0, 0)
        windows, which = np.unique(table, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.argsort(which, kind="stable")
        self.item, self.inner = item[order], inner[order]
        self.uses = np.searchsorted(which[order], np.arange(len(windows) + 1))
        self.length = (windows > 0).sum(axis=1) if len(windows) else np.zeros(0, np.int64)
        self.shortest = int(self.length.min()) if len(windows) else 0
        self.low = packed(windows, self.bits)
        self.high = packed(np.where(windows > 0, windows, (1 << self.bits) - 1), self.bits)


def packed(table: np.ndarray, bits: int) -> list[np.ndarray]:
    """Columns of numbers packed into as few 63-bit columns that sort alike."""
    per = 63 // bits
    out = []
    for at in range(0, table.shape[1], per):
        key = np.zeros(len(table), np.int64)
        for k in range(at, min(at + per, table.shape[1])):
            key = (key << bits) | table[:, k]
        out.append(key)
    return out


def bound(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of all wanted rows at once in sorted rows, both as columns."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        at = np.minimum(mid, len(keys[0]) - 1)
        less = np.full(len(low), after)
        for key, want in zip(reversed(keys), reversed(wanted)):
            k = key[at]
            less = (k < want) | ((k == want) & less)
        low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
    return low


def search(block: Block, h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hit flags of the words of a shard, and its longest matches: row, item, start word, words."""
    hit, none = np.zeros(len(h), bool), [np.zeros(0, np.int64)] * 4
    if not len(block.length) or not len(h):
        return hit, none
    may = np.flatnonzero(block.maybe[(h >> np.uint64(48)).astype(np.int64)])
    place = np.searchsorted(block.vocabulary, h[may])
    same = block.vocabulary[np.minimum(place, len(block.vocabulary) - 1)] == h[may]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    number = np.zeros(len(h) + len(at) + window, np.int64)
    number[may[same] + row[may[same]]] = place[same] + 1
    foreign = np.append(np.flatnonzero(number == 0), len(number))
    start = np.flatnonzero(number)
    start = start[foreign[np.searchsorted(foreign, start)] - start >= block.shortest]
    if not len(start):
        return hit, none
    keys = packed(number[start[:, None] + np.arange(window)], block.bits)
    order = np.lexsort(keys[::-1])
    suffixes, keys = start[order], [k[order] for k in keys]
    low, high = bound(keys, block.low, False), bound(keys, block.high, True)
    found = np.flatnonzero(high > low)
    n = (high - low)[found]
    test = np.repeat(found, n)
    where = suffixes[np.repeat(low[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    rows = np.searchsorted(at + np.arange(len(at)), where, "right") - 1
    word = where - rows
    mark = np.zeros(len(h) + 1, np.int64)
    np.add.at(mark, word, 1)
    np.add.at(mark, word + block.length[test], -1)
    hit = np.cumsum(mark[:-1]) > 0
    uses = np.diff(block.uses)[test]
    use = np.repeat(block.uses[test] - (np.cumsum(uses) - uses), uses) + np.arange(uses.sum())
    rows, word, item, inner, length = (np.repeat(x, uses) for x in (rows, word, test, test, block.length[test]))
    item, inner = block.item[use], block.inner[use]
    order = np.lexsort((word, word - inner, item, rows))
    rows, word, item, inner, length = (x[order] for x in (rows, word, item, inner, length))
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (np.diff(rows) != 0) | (np.diff(item) != 0) | (np.diff(word - inner) != 0) | (np.diff(word) != 1)
    first = np.flatnonzero(fresh)
    run = np.diff(np.append(first, len(rows)))
    return hit, [rows[first], item[first], word[first] - at[rows[first]], length[first] + run - 1]


def _outputs(part: pa.RecordBatch, block: Block, window: int, more: bool) -> list[pa.Array]:
    """The arrays of OUTPUT for a slice; with `more`, joined with those of earlier blocks."""
    h, at = W.words(part.column("__text"))
    hit, (rows, item, start, length) = search(block, h, at, window)
    n = part.num_rows
    items, matches = [[] for _ in range(n)], [[] for _ in range(n)]
    for r, i, s, w in zip(rows.tolist(), block.ids[item].tolist(), start.tolist(), length.tolist()):
        matches[r].append({"item_id": i, "start": s, "words": w})
        items[r].append(i)
    before = [part.column(c).to_pylist() for c in ("hit_bits", "items", "matches")] if more else [[None] * n] * 3
    bits, hits = [], []
    for r in range(n):
        own = hit[at[r] : at[r + 1]]
        if before[0][r] is not None:
            own = own | np.unpackbits(np.frombuffer(before[0][r], np.uint8), count=len(own)).astype(bool)
        hits.append(int(own.sum()))
        bits.append(np.packbits(own).tobytes() if hits[-1] else None)
        items[r] = sorted(set(items[r]) | set(before[1][r] or ()))
        matches[r] = (before[2][r] or []) + matches[r]
    return [pa.array(np.diff(at), pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(matches, MATCHES), pa.array(bits, pa.binary())]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[Block]:
    tests = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for k in range(n):
        rows = tests.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        yield Block([r["id"] for r in rows], pa.array([r["text"] for r in rows], pa.string()), window)


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add to each document n_words, n_hit, items, matches and hit_bits.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one
    window. n_hit counts the document's words inside an occurrence of any window, items are the
    sorted ids of the items with such windows, matches the longest verbatim matches (item_id, start word,
    words), hit_bits one bit for each word (null without a hit). Null texts have no words; items without
    words hit nothing; a null item id is the empty string; items that share an id count once; rows of
    documents may repeat. Input columns named like an output are replaced. The benchmark is
    collected block by block, each of about `block_bytes` of text; with more than one block,
    the table is written between blocks.
    """
    docs = without(docs, OUTPUT)
    spark = docs.sparkSession
    names = [c for c in docs.columns]
    out = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    match = T.StructType().add("item_id", "string").add("start", "long").add("words", "long")
    extra = T.StructType().add("n_words", "long").add("n_hit", "long").add("items", T.ArrayType(T.StringType())).add("matches", T.ArrayType(match)).add("hit_bits", "binary")
    schema = T.StructType(out.schema.fields + extra.fields)
    for k, block in enumerate(_blocks(benchmark, id_col, text_col, window, block_bytes)):
        sent = spark.sparkContext.broadcast(block)

        def look(batches, sent=sent, more=k > 0):
            for batch in batches:
                for part in W.slices(batch, "__text"):
                    own = part.columns[: len(names) + 1]
                    yield pa.RecordBatch.from_arrays([*own, *_outputs(part, sent.value, window, more)], names=[f.name for f in schema.fields])

        out = (staged(out) if k else out).mapInArrow(look, schema)
    return out.drop("__text")


def contaminated(share: int = 20):
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents of which less than a twentieth of the words lie in benchmark passages."""
    held, restore = apart(docs, OUTPUT)
    return restore(find_passages(held, benchmark, **kw).filter(~contaminated()))


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
