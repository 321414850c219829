"""Near-duplicate embeddings by collision-counting projections.

1. Equal vectors of one label are one node, so copies never meet each other.
2. Nodes are dealt to cells: TABLES of signs of random projections, as many signs as bring a cell of the label to about
   CELL nodes, and as many tables as leave a pair at the threshold apart in all of them with a chance of at most MISS.
3. In a cell PROJECTIONS further projections are sorted. A query's window in each is an interval of ranks around it;
   the windows that hold a node are counted, and a pair is verified, in double precision, if its count reaches LEAST.
   Differences of projections are normal with a known spread, so counts of pairs at the threshold are binomial and
   LEAST follows from MISS, whatever the data.
4. A pair counts in the first table in which it shares a cell. A task gives a number of links for each node and one
   edge to a node of its component there, never a row for each pair. Cells of more than WIDTH nodes are cut to
   blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm.common import join_groups, staged, without
from cellsheaf.llm.op06_near_dedup import components

THRESHOLD = 0.98
#: Chance of missing a pair at the threshold: by the cells, and once more by the counts.
MISS = 1e-6
CELL = 1024
#: Signs of a table at most, and tables for which signs are drawn.
SIGNS, TABLES = 24, 64
PROJECTIONS = 16
#: Half a window, in standard deviations of the difference of two projections at the threshold.
REACH = 2.5
#: Nodes of a block: least and most (ranks have 16 bits); a node meets at most BLOCKS others until blocks are that large.
WIDTH, WIDEST, BLOCKS = 2048, 65_535, 64
#: Pairs that are counted or verified at a time.
AT_ONCE = 1 << 20
OUTPUT = ["n_links", "component_id", "kept"]


def signs_of(nodes: int) -> int:
    return min(SIGNS, max(0, math.ceil(math.log2(max(nodes, 1) / CELL))))


def tables_of(signs: int, threshold: float) -> int:
    """Tables after which a pair at the threshold has shared no cell with a chance of at most MISS."""
    apart = 1 - (1 - math.acos(threshold) / math.pi) ** signs
    return 1 if apart <= MISS else min(TABLES, math.ceil(math.log(MISS) / math.log(apart)))


def least_count() -> int:
    """The largest number of windows that a pair at the threshold shares but with a chance of MISS."""
    p = math.erf(REACH / math.sqrt(2))
    below, least = 0.0, 0
    while (below := below + math.comb(PROJECTIONS, least) * p**least * (1 - p) ** (PROJECTIONS - least)) <= MISS:
        least += 1
    return least


def directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions of the signs (table by table) and of the windows, for vectors of a size."""
    rng = np.random.default_rng(12_000 + size)
    return rng.standard_normal((size, TABLES * SIGNS)), rng.standard_normal((size, PROJECTIONS)) / math.sqrt(size)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def keys_of(x: np.ndarray, signs: int, tables: int, draws: np.ndarray) -> np.ndarray:
    """The cell of each unit vector in each table."""
    out = np.zeros((len(x), tables), np.int32)
    for t in range(tables):
        bits = x @ draws[:, t * SIGNS : t * SIGNS + signs] > 0
        out[:, t] = bits @ (1 << np.arange(signs, dtype=np.int32)) if signs else 0
    return out


def collisions(a: np.ndarray, b: np.ndarray, reach: float, least: int):
    """Runs of rows of `a` (start, end) with the index pairs (row of a, row of b) whose windows collide `least` times or more."""
    ranks = np.empty(b.shape, np.uint16)
    low, width = np.empty(a.shape, np.uint16), np.empty(a.shape, np.uint16)
    for k in range(a.shape[1]):
        order = np.argsort(b[:, k], kind="stable")
        ranks[order, k] = np.arange(len(b))
        line = b[order, k]
        first = np.searchsorted(line, a[:, k] - reach, "left")
        low[:, k], width[:, k] = first, np.searchsorted(line, a[:, k] + reach, "right") - first
    ranks, step = np.ascontiguousarray(ranks.T), max(1, AT_ONCE // max(1, len(b)))
    for at in range(0, len(a), step):
        to = min(at + step, len(a))
        count = np.zeros((to - at, len(b)), np.uint8)
        for k, own in enumerate(ranks):
            count += (own[None, :] - low[at:to, k, None]) < width[at:to, k, None]
        i, j = np.nonzero(count >= least)
        yield at, to, i + at, j


def merged(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (smallest index) of the components after links i-j; `root` points at roots."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def linked(x: np.ndarray, y: np.ndarray, keys_x: np.ndarray, keys_y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, table: int, threshold: float, same: bool):
    """Links of unit vectors x with y, as sums of the partners' multiplicities, and the root of each of x and then y."""
    draws = directions(x.shape[1])[1]
    reach = REACH * math.sqrt(2 - 2 * threshold) / math.sqrt(x.shape[1])
    root = np.arange(len(x) if same else len(x) + len(y))
    links_x, links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    for _, _, i, j in collisions(x @ draws, y @ draws, reach, least_count()):
        keep = i < j if same else np.ones(len(i), bool)
        for t in range(table):
            keep &= keys_x[i, t] != keys_y[j, t]
        i, j = i[keep], j[keep]
        step = max(1, 16 * AT_ONCE // x.shape[1])
        near = [np.einsum("ij,ij->i", x[i[k : k + step]], y[j[k : k + step]]) >= threshold for k in range(0, len(i), step)]
        near = np.concatenate(near) if near else np.zeros(0, bool)
        i, j = i[near], j[near]
        np.add.at(links_x, i, n_y[j])
        np.add.at(links_y, j, n_x[i])
        root = merged(root, i, j if same else j + len(x))
    return (links_x + links_y if same else np.concatenate([links_x, links_y])), root


def _cells(nodes: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """Add keys (the cell in each table) and `vector` as bytes to nodes (label, size, rep, n, embedding, m: nodes of the label)."""

    def sign(batches):
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            held = batch.column("embedding")
            size, m = batch.column("size").to_numpy(), batch.column("m").to_numpy()
            values, ends = np.asarray(held.values, dtype), held.offsets.to_numpy()
            keys: list = [None] * batch.num_rows
            for d, nodes_of in {*zip(size.tolist(), m.tolist())}:
                rows = np.flatnonzero((size == d) & (m == nodes_of))
                if d not in drawn:
                    drawn = {d: directions(d)[0]}
                signs = signs_of(nodes_of)
                x = unit(values[ends[rows][:, None] + np.arange(d)].astype(np.float64))
                for row, own in zip(rows, keys_of(x, signs, tables_of(signs, threshold), drawn[d])):
                    keys[row] = own.tolist()
            vectors = [values[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("label", "size", "rep", "n")), pa.array(keys, pa.list_(pa.int32())), pa.array(vectors, pa.binary())],
                names=["label", "size", "rep", "n", "keys", "vector"],
            )

    kind = dict(nodes.dtypes)["label"]
    return nodes.select("label", "size", "rep", "n", "m", "embedding").mapInArrow(sign, f"label {kind}, size int, rep long, n long, keys array<int>, vector binary")


def _links(cells: DataFrame, dtype: str, threshold: float, widest: int) -> DataFrame:
    """rep, links (vectors linked to it by one task) and parent (a node of its component in that task) of linked nodes."""
    cell = ["label", "size", "table", "key"]
    rows = cells.select("label", "size", "rep", F.posexplode("keys").alias("table", "key"))
    sizes = staged(rows.groupBy(*cell).agg(F.count("*").alias("members")).filter("members > 1"))
    total = cells.agg(F.sum(F.size("keys"))).first()[0] or 0
    full = cells.select("label", "size", "rep", "n", "vector", "keys", F.posexplode("keys").alias("table", "key"))
    met = join_groups(full, sizes, cell, "members", total, 48).filter("members is not null")
    width = F.least(F.greatest(F.col("members") / BLOCKS, F.lit(min(WIDTH, widest))), F.lit(widest))
    # Blocks are dealt by hash, so they are planned at three quarters of what ranks can tell apart.
    met = met.withColumn("blocks", F.when(F.col("members") <= min(WIDTH, widest), 1).otherwise(F.ceil(F.col("members") / (0.75 * width))))
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    tiled = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiled = tiled.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).drop("other", "blocks", "members")

    def compare(group: pa.Table) -> pa.Table:
        d, table = group.column("size")[0].as_py(), group.column("table")[0].as_py()
        x = unit(np.frombuffer(b"".join(group.column("vector").to_pylist()), dtype).reshape(-1, d).astype(np.float64))
        rep, n, block = (group.column(c).to_numpy() for c in ("rep", "n", "block"))
        keys = np.array(group.column("keys").to_pylist(), np.int32)
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        own = left if p == q else np.concatenate([left, right])
        links, root = linked(x[left], x[right], keys[left], keys[right], n[left], n[right], table, threshold, p == q)
        some = links > 0
        return pa.table({"rep": rep[own][some], "links": links[some], "parent": rep[own][root][some]})

    return tiled.groupBy(*cell, "p", "q").applyInArrow(compare, "rep long, links long, parent long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, widest: int = WIDEST) -> DataFrame:
    """Add n_links, component_id and kept to every row of vectors (vec_id, embedding, label).

    Rows link if their labels are equal and not null and the cosine of their vectors, in double precision, is at least `threshold`;
    vectors of different sizes never do. A vector that is null, empty or zero or holds null or non-finite
    components links with nothing, and neither does a row without vec_id (its component_id is null and it is kept). Each row
    counts as a vector, also where rows repeat a vec_id; a component has the smallest vec_id in it.
    Columns named like an output are replaced, others stay. An empty table gives an empty result.
    """
    vectors = without(vectors, [*OUTPUT, "__h1", "__h2", "__size"])
    kind = dict(vectors.dtypes)["embedding"]
    dtype, element = ("<f4", "float") if kind == "array<float>" else ("<f8", "double")
    x = F.col("embedding").cast(f"array<{element}>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & good, F.lit(False))
    vectors = vectors.withColumns(
        {"__size": F.when(usable, F.size(x)), "__h1": F.when(usable, F.xxhash64(F.lit(1), x)), "__h2": F.when(usable, F.xxhash64(F.lit(2), x))}
    )
    same = vectors.filter("__size is not null").groupBy("label", F.col("__size").alias("size"), "__h1", "__h2")
    nodes = staged(same.agg(F.min(F.col("vec_id").cast("long")).alias("rep"), F.count("*").alias("n"), F.first(x).alias("embedding")))
    labels = staged(nodes.groupBy("label", "size").agg(F.count("*").alias("m")))
    total = nodes.count()
    cells = staged(_cells(join_groups(nodes, labels, ["label", "size"], "m", total, 32), dtype, threshold))
    found = staged(_links(cells, dtype, threshold, widest))
    roots = components(found.filter("rep <> parent").select(F.col("parent").alias("star"), F.col("rep").alias("member")).distinct())
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    rooted = counts.join(roots.withColumnRenamed("node", "rep"), "rep", "full")
    classes = staged(
        nodes.drop("embedding").withColumnRenamed("size", "__size").join(rooted, "rep", "left").filter("n > 1 or links is not null").select(
            "label", "__size", "__h1", "__h2", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("__links"), F.coalesce("root", "rep").alias("__root")
        )
    )
    met = join_groups(vectors, classes, ["label", "__size", "__h1", "__h2"], "n", vectors.count(), 64)
    root = F.coalesce("__root", F.col("vec_id").cast("long"))
    return met.select(
        *[F.col(f"`{c}`") for c in vectors.columns if c not in ("__size", "__h1", "__h2")],
        F.coalesce("__links", F.lit(0).cast("long")).alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"),
    )


def op12_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select("vec_id", *OUTPUT)


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
