"""Near-duplicates by improved consistent weighted sampling over TF-IDF weighted word shingles.

1. One scan counts in how many documents a shingle occurs, in a table of a fixed number of
   counters (shingles share one by hash), which all tasks' tables are added up to. The weight of a shingle is its number of
   occurrences times 1 + log((1+N)/(1+df)) / log(1+N), which lies between 1 and 2 times that number.
2. One scan takes HASHES samples of each document (improved consistent weighted sampling: two documents
   share a sample with the probability of their weighted Jaccard similarity) and hashes them to BANDS keys.
3. Documents of the same words are one node. In a bucket of a band every node is paired with one
   node, the star, so pairs grow with the members and not with their square. Pairs are
   verified on their texts by exact weighted Jaccard similarity; links make components. In buckets that still hold
   several components all pairs of different ones are compared: in small buckets on their texts. Larger ones that
   share members become one set, each member in it once, dealt to blocks; a task of two blocks compares by the samples that agree,
   then by shingles if AGREE or more do (a pair at the threshold has fewer with a chance of about 1 in a thousand million),
   skips what it has already connected and gives one link for each join of two components, never a row for a pair.

Only ids, keys and counts are shuffled, and the texts of paired documents or of members of sets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsheaf.llm import words as W
from cellsheaf.llm.common import apart, fits, join_groups, staged, union_all

SHINGLE = 5
THRESHOLD = 0.8
HASHES, BANDS = 64, 16
COUNTER_BITS, BLOCK_BITS = 22, 16
#: Members that one task verifies against a star at a time.
STAR_MEMBERS = 16
#: Members of a small bucket, whose pairs are all verified.
SMALL = 9
#: Samples that agree in pairs of larger buckets that are verified; members of a block, least and most, and blocks until they are that large.
AGREE = 30
BLOCK_LEAST, BLOCK_MOST, BLOCKS = 2048, 4096, 64
#: Partial tables that one task adds up.
FAN_IN = 64

_RNG = np.random.default_rng(6)
_DRAWS = 1 << 16
_R = _RNG.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
_LOG_C = np.log(_RNG.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)
_BETA = _RNG.random(_DRAWS).astype(np.float32)
_INV_R = (1 / _R).astype(np.float32)
_TURNS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the words of one document, sorted, and how often each occurs."""
    s = np.sort(W.shingles(h, SHINGLE))
    if not len(s):
        return s, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return s[first], np.diff(np.append(first, len(s)))


def weights(s: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return n.astype(np.float32) * idf[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight factor by counter, from all documents (doc_id, text)."""

    def count(batches):
        from pyspark import TaskContext

        table = np.zeros(1 << COUNTER_BITS, np.uint32)
        rows = 0
        for batch in batches:
            for part in W.slices(batch, "text"):
                h, at = W.words(part.column("text"))
                own = [counted(h[i:j])[0] for i, j in zip(at[:-1], at[1:]) if j > i]
                rows += len(own)
                if own:
                    table += np.bincount((np.concatenate(own) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(table)).astype(np.uint32)
        yield _blocks(TaskContext.get().partitionId(), dict(enumerate(table.reshape(-1, 1 << BLOCK_BITS))) if rows else {})

    def add(batches):
        tables: dict = {}
        for batch in batches:
            for group, block, data in zip(*(batch.column(c).to_pylist() for c in ("group", "block", "data"))):
                own = np.frombuffer(zlib.decompress(data), "<u4")
                tables[group, block] = tables[group, block] + own if (group, block) in tables else own
        for group in sorted({g for g, _ in tables}):
            yield _blocks(group, {b: t for (g, b), t in tables.items() if g == group})

    schema = "part long, block int, data binary"
    partial = staged(docs.select("text").mapInArrow(count, schema))
    parts = (partial.agg(F.max("part")).first()[0] or 0) + 1
    blocks = 1 << (COUNTER_BITS - BLOCK_BITS)
    while True:
        groups = -(-parts // FAN_IN)
        spread = partial.withColumn("group", F.floor(F.col("part") / FAN_IN)).repartition(max(1, min(groups * blocks, 4 * blocks)), "group", "block")
        partial, parts = staged(spread.mapInArrow(add, schema)), groups
        if groups == 1:
            break
    total = docs.count()
    df = np.zeros(1 << COUNTER_BITS, np.float32)
    for row in partial.collect():
        df[row["block"] << BLOCK_BITS : (row["block"] + 1) << BLOCK_BITS] = np.frombuffer(zlib.decompress(row["data"]), "<u4")
    return (1 + np.log((1 + total) / (1 + np.minimum(df, total))) / np.log(2 + total)).astype(np.float32)


def _blocks(part: int, tables: dict[int, np.ndarray]) -> pa.RecordBatch:
    kept = [(b, zlib.compress(t.astype("<u4").tobytes(), 1)) for b, t in tables.items() if t.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(kept), pa.int64()), pa.array([b for b, _ in kept], pa.int32()), pa.array([d for _, d in kept], pa.binary())], names=["part", "block", "data"]
    )


def samples(s: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """HASHES samples (low bits of the drawn shingle) of each document whose shingles begin at `first`."""
    log_w, low = np.log(w), s & np.uint64(0xFFFFFFFF)
    out = np.empty((len(first), HASHES), np.uint64)
    for k in range(HASHES):
        draw = ((s * _TURNS[k]) >> np.uint64(48)).astype(np.int64)
        beta = _BETA[draw]
        t = np.floor(log_w * _INV_R[draw] + beta)
        a = _LOG_C[draw] - _R[draw] * (t - beta + np.float32(1))
        bits = a.view(np.uint32)
        bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
        out[:, k] = np.minimum.reduceat((bits.astype(np.uint64) << np.uint64(32)) | low, first)
    return out & np.uint64(0xFFFFFFFF)


def band_keys(found: np.ndarray) -> np.ndarray:
    rows = HASHES // BANDS
    out = np.zeros((len(found), BANDS), np.uint64)
    for k in range(rows):
        out = W.mixed(out + found[:, k::rows] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return out.view(np.int64)


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, w1 and w2 (128-bit hash of the words, null without any), the band keys and 16 bits of each sample of each document."""

    def sign(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                h, at = W.words(part.column("text"))
                n = part.num_rows
                filled = np.flatnonzero(np.diff(at))
                keys, sketch = np.zeros((n, BANDS), np.int64), np.zeros((n, HASHES), "<u2")
                if len(filled):
                    own = [counted(h[at[i] : at[i + 1]]) for i in filled]
                    s, c = (np.concatenate(x) for x in zip(*own))
                    first = np.cumsum([0, *(len(x) for x, _ in own)])[:-1]
                    found = samples(s, weights(s, c, idf.value), first)
                    keys[filled], sketch[filled] = band_keys(found), found & np.uint64(0xFFFF)
                place = np.arange(len(h), dtype=np.uint64) - np.repeat(at[:-1], np.diff(at)).astype(np.uint64)
                sums = [np.append(np.uint64(0), np.cumsum(W.mixed(h + place * np.uint64(odd)))) for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
                none = np.diff(at) == 0
                words = [pa.array((x[at[1:]] - x[at[:-1]]).view(np.int64), mask=none) for x in sums]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1)))
                bits = pa.array([x.tobytes() for x in sketch], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *words, lists, bits], names=["doc_id", "w1", "w2", "keys", "sketch"])

    return docs.mapInArrow(sign, "doc_id long, w1 long, w2 long, keys array<long>, sketch binary")


def verified(pairs: DataFrame, docs: DataFrame, idf, threshold: float) -> DataFrame:
    """Of the pairs (star, member), those whose weighted Jaccard similarity reaches the threshold.

    A star's members are dealt to groups of about STAR_MEMBERS, each with a copy of the star's text.
    """
    sizes = staged(pairs.groupBy("star").agg(F.count("*").alias("n")))
    subs = F.ceil(F.col("n") / STAR_MEMBERS)
    dealt = join_groups(pairs, sizes, ["star"], "n", pairs.count(), 32)
    members = dealt.select("star", "member", F.pmod(F.xxhash64("member"), subs).alias("sub"))
    stars = sizes.select("star", F.col("star").alias("member"), F.explode(F.sequence(F.lit(0).cast("long"), subs - 1)).alias("sub"))
    roles = members.union(stars)
    texts = docs.withColumnRenamed("doc_id", "member")
    small = fits(pairs.count() + (sizes.agg(F.sum(subs)).first()[0] or 0), 40)
    rows = texts.join(F.broadcast(roles) if small else roles, "member")

    def compare(group: pa.Table) -> pa.Table:
        star = group.column("star")[0].as_py()
        texts = group.column("text").combine_chunks()
        h, at = W.words(texts)
        own = [counted(h[i:j]) for i, j in zip(at[:-1], at[1:])]
        valued = [(s, weights(s, n, idf.value)) for s, n in own]
        ids = group.column("member").to_pylist()
        stars = [v for i, v in zip(ids, valued) if i == star]
        found = [i for i, v in zip(ids, valued) if i != star and any(similarity(v, x) >= threshold for x in stars)]
        return pa.table({"star": pa.array([star] * len(found), pa.int64()), "member": pa.array(found, pa.int64())})

    return rows.groupBy("star", "sub").applyInArrow(compare, "star long, member long")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted shingle sets with weights; of two empty ones 0."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared = np.minimum(a[1][both], b[1][at[both]]).sum(dtype=np.float64)
    return shared / (a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - shared)


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of a link (star, member).

    Each round maps a node to its smallest neighbour, or itself, and contracts the links by that;
    chains fold up, so the rounds grow with the logarithm of the longest one.
    """
    edges = links.select(F.col("star").alias("a"), F.col("member").alias("b"))
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("parent")))
        if roots is None:
            roots = parents.withColumnRenamed("parent", "root")
        else:
            up = parents.select(F.col("node").alias("root"), "parent")
            roots = roots.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        for end in ("a", "b"):
            edges = edges.join(parents.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_up")), end)
        edges = staged(edges.select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).filter("a <> b").distinct())
    return staged(roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root")))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, class_id (the smallest doc_id of the class), class_size, kept.

    Documents link at a weighted Jaccard similarity of `threshold` of their five-word shingles
    (fewer than five words are one shingle); classes are the components of the links. Documents with the same
    words are of one class. A document without words is a class of its own. A null doc_id takes its
    class from documents with the same words and links nothing else. Rows that repeat a doc_id are
    one document. Only doc_id and text are read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    idf = context.broadcast(inverse_frequencies(docs))
    signed = staged(signatures(docs, idf))
    same = signed.filter("w1 is not null").groupBy("w1", "w2")
    nodes = staged(same.agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    rows = nodes.filter("rep is not null").select("rep", F.posexplode("keys").alias("band", "key"))
    buckets = staged(rows.groupBy("band", "key").agg(F.min("rep").alias("star"), F.count("*").alias("size")).filter("size > 1"))
    met = staged(join_groups(rows, buckets, ["band", "key"], "size", BANDS * nodes.count(), 40).filter("size is not null"))
    tested = [staged(met.filter("rep <> star").select("star", F.col("rep").alias("member")).distinct())]
    links = [staged(verified(tested[0], docs, idf, threshold))]
    roots = components(links[0])
    # All pairs of the buckets that still hold several components: of the small ones, then of those larger ones that are left.
    small = staged(_small_pairs(met, roots).join(tested[0], ["star", "member"], "left_anti"))
    if not small.isEmpty():
        tested.append(small)
        links.append(staged(verified(small, docs, idf, threshold)))
        roots = components(union_all(links))
    large = _large_links(met, roots, nodes.select("rep", "sketch"), docs, idf, threshold)
    if large is not None:
        links.append(staged(large))
        roots = components(union_all(links))
    classes = nodes.drop("keys", "sketch").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class_id", F.coalesce("root", "rep"))
    classes = staged(classes.select("w1", "w2", "n", "class_id"))
    sizes = staged(classes.groupBy("class_id").agg(F.sum("n").alias("class_size"), F.count("*").alias("m")).filter("class_size > 1"))
    grown = staged(join_groups(classes, sizes, ["class_id"], "m", classes.count(), 40).filter("class_size is not null").select("w1", "w2", "n", "class_id", "class_size"))
    keyed = signed.select("doc_id", F.coalesce("w1", F.lit(0)).alias("w1"), F.coalesce("w2", F.col("doc_id"), F.lit(0)).alias("w2"))
    out = join_groups(keyed, grown, ["w1", "w2"], "n", keyed.count(), 60)
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.coalesce("class_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def _mixed(met: DataFrame, roots: DataFrame, sizes: Column) -> DataFrame:
    """Members (band, key, star, rep, root, size) of the buckets of such sizes that hold more than one component."""
    labelled = met.filter(sizes).select("band", "key", "star", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    found = labelled.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
    mixed = staged(found.filter("low <> high").select("band", "key", "size"))
    return join_groups(labelled, mixed, ["band", "key"], "size", met.count(), 40).filter("size is not null")


def _small_pairs(met: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs of members of different components in mixed buckets of at most SMALL members."""
    order = Window.partitionBy("band", "key").orderBy("rep")
    ahead = F.collect_list(F.struct("rep", "root")).over(order.rowsBetween(1, SMALL))
    met_with = _mixed(met, roots, F.col("size") <= SMALL).withColumn("ahead", ahead)
    pairs = met_with.select("rep", "root", F.explode("ahead").alias("o")).filter("o.root <> root")
    return pairs.select(F.least("rep", "o.rep").alias("star"), F.greatest("rep", "o.rep").alias("member")).distinct()


def _large_links(met: DataFrame, roots: DataFrame, sketches: DataFrame, docs: DataFrame, idf, threshold: float) -> DataFrame | None:
    """Links (star, member) that join different components in larger mixed buckets, at most one fewer a task than its members; None without such buckets.

    Buckets with a member in common are one set, so that a member comes once and not once a band. Every two blocks of a set meet in a task;
    blocks of sets of up to BLOCKS * BLOCK_MOST members grow with them, so a member has at most BLOCKS copies there.
    """
    inside = staged(_mixed(met, roots, F.col("size") > SMALL))
    if inside.isEmpty():
        return None
    sets = components(inside.filter("star <> rep").select("star", F.col("rep").alias("member")).distinct())
    members = staged(inside.select("rep", "root").distinct().join(sets.select(F.col("node").alias("rep"), F.col("root").alias("set")), "rep").join(sketches, "rep"))
    total = members.count()
    sizes = staged(members.groupBy("set").agg(F.count("*").alias("m")))
    width = F.least(F.greatest(F.col("m") / BLOCKS, F.lit(BLOCK_LEAST)), F.lit(BLOCK_MOST))
    dealt = join_groups(members, sizes, ["set"], "m", total, 16).withColumn("blocks", F.ceil(F.col("m") / width))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumnRenamed("rep", "doc_id")
    texts = docs.join(F.broadcast(dealt) if fits(total, 240) else dealt, "doc_id")
    tiled = texts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiled = tiled.select("set", "doc_id", "root", "sketch", "text", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))

    def compare(group: pa.Table) -> pa.Table:
        ids, root, block = (group.column(c).to_numpy() for c in ("doc_id", "root", "block"))
        root = np.unique(root, return_inverse=True)[1]
        bits = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u2").reshape(-1, HASHES)
        h, at = W.words(group.column("text").combine_chunks())
        bags = [counted(h[i:j]) for i, j in zip(at[:-1], at[1:])]
        size = np.array([len(s) for s, _ in bags])
        first = np.append(0, np.cumsum(size))
        shingle = np.concatenate([s for s, _ in bags])
        weight = weights(shingle, np.concatenate([n for _, n in bags]), idf.value)
        known, shingle = np.unique(shingle, return_inverse=True)
        sums = np.add.reduceat(weight, first[:-1], dtype=np.float64)
        held = np.zeros(len(known), np.float32)
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        columns = np.ascontiguousarray(bits[right].T)
        stars, found = [], []
        for i in left:
            apart = root[right] != root[i]
            if not apart.any():
                continue
            equal = np.zeros(len(right), np.uint8)
            for own, column in zip(bits[i], columns):
                equal += column == own
            near = right[(equal >= AGREE) & apart & ((right > i) if p == q else True)]
            if not len(near):
                continue
            mine = slice(first[i], first[i + 1])
            held[shingle[mine]] = weight[mine]
            starts = np.append(0, np.cumsum(size[near])[:-1])
            rows = np.repeat(first[near] - starts, size[near]) + np.arange(size[near].sum())
            shared = np.add.reduceat(np.minimum(weight[rows], held[shingle[rows]]), starts, dtype=np.float64)
            held[shingle[mine]] = 0
            for j in near[shared / (sums[i] + sums[near] - shared) >= threshold]:
                if root[i] != root[j]:
                    root[root == root[j]] = root[i]
                    stars.append(ids[i])
                    found.append(ids[j])
        return pa.table({"star": pa.array(stars, pa.int64()), "member": pa.array(found, pa.int64())})

    return tiled.groupBy("set", "p", "q").applyInArrow(compare, "star long, member long")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each class of near-duplicates left (that with the smallest doc_id), with their own columns."""
    held, restore = apart(docs, ["class_id", "class_size", "kept"])
    gone = staged(near_classes(held).filter("not kept").select("doc_id").distinct())
    return restore(held.join(F.broadcast(gone) if fits(gone.count(), 16) else gone, "doc_id", "left_anti"))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
