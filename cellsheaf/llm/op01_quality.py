"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression.

Statistics are taken from each whole text in numpy over the bytes of a batch. The random features
approximate a Gaussian kernel over the standardised statistics; each partition adds up its part of the
normal equations, the parts are summed by blocks of rows, and the driver solves one system whose size
is that of the features. The calibration works on counts in a fixed number of score bins. So
all labelled rows take part and nothing that is collected grows with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm import words as W
from cellsheaf.llm.common import staged
from cellsheaf.llm.labelled import held_out, training_labels

FEATURES, WIDTH, RIDGE, BLOCK_ROWS = 256, 2.0, 1e-3, 32
#: Score bins of the calibration: from LOW to HIGH in BINS steps.
LOW, HIGH, BINS = -1.0, 2.0, 6000
STATISTICS = (
    "log_bytes", "lower", "upper", "digit", "space", "newline", "stop", "comma", "shout", "bar", "symbol", "beyond_ascii", "word_bytes", "word_spread",
    "distinct_words", "top_word", "adjacent", "distinct_pairs", "distinct_fives", "line_words", "distinct_lines", "log_words",
)
OUTPUT = ["held_out", "score", "predicted"]
_KIND = np.full(256, 9, np.int64)
for _chars, _k in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t\r", 3), (b"\n", 4), (b".;:", 5), (b",", 6), (b"!?", 7), (b"|", 8), (range(128, 256), 10)):
    _KIND[list(_chars)] = _k


def _distinct(h: np.ndarray) -> tuple[int, int]:
    """Distinct values and the count of the most frequent one."""
    if not len(h):
        return 0, 0
    s = np.sort(h)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return len(first), int(np.diff(np.append(first, len(s))).max())


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all 0 for an empty one."""
    data, rows = W.raw(column)
    size = np.diff(rows)
    n = len(size)
    out = np.zeros((n, len(STATISTICS)))
    kind = np.bincount(np.repeat(np.arange(n) * 11, size) + _KIND[data], minlength=11 * n).reshape(n, 11)
    out[:, 0] = np.log1p(size)
    out[:, 1:12] = kind / np.maximum(size, 1)[:, None]
    start, end = W.spans(data, rows)
    h, length = W.hashes(data, start, end), (end - start).astype(np.float64)
    at = np.searchsorted(start, rows)
    ends = np.flatnonzero(data == 10)
    # A line is known by the order-sensitive sum of its words.
    line = np.searchsorted(ends, start) + np.searchsorted(rows, start, "right")
    for r in range(n):
        i, j = at[r], at[r + 1]
        m = j - i
        if not m:
            continue
        own, size_ = h[i:j], length[i:j]
        distinct, top = _distinct(own)
        pairs, fives = (W.shingles(own, k) for k in (2, 5))
        first = np.flatnonzero(np.append(True, np.diff(line[i:j]) != 0))
        lines = np.add.reduceat(W.mixed(own + np.arange(m, dtype=np.uint64) - np.repeat(first, np.diff(np.append(first, m))).astype(np.uint64)), first)
        out[r, 12:] = (
            size_.mean(), size_.std(), distinct / m, top / m, (own[1:] == own[:-1]).sum() / m, _distinct(pairs)[0] / len(pairs),
            _distinct(fives)[0] / len(fives), np.log1p(m / len(lines)), _distinct(lines)[0] / len(lines), np.log1p(m),
        )
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id and stats, an array of STATISTICS, of each document; a null text is empty."""

    def describe(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                stats = statistics(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * stats.shape[1], pa.int32()), pa.array(stats.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "stats"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(describe, "doc_id long, stats array<double>")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Model:
    """Standardisation, random features, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.turn = rng.normal(0, 1 / (width * np.sqrt(len(mean))), (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps = (np.array([LOW, HIGH]), np.array([0.5, 0.5]))

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.turn + self.phase)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), *self.steps)


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows (stats, y), classes weighing the same in total."""
    width = len(STATISTICS)
    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    share = {y: sum(totals.values()) / (2 * n) for y, n in totals.items()}
    sent = rows.sparkSession.sparkContext.broadcast((model, share))
    d = len(model.weights)

    def gather(batches):
        model, share = sent.value
        total = np.zeros((d, d + 1))
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            z = model.features(_matrix(batch.column("stats"), width))
            zw = z * np.where(y == 1, share.get(1, 1), share.get(0, 1))[:, None]
            total += np.hstack([z.T @ zw, (zw.T @ y)[:, None]])
        yield _parts(total)

    def _parts(total):
        blocks = [total[i : i + BLOCK_ROWS].tobytes() for i in range(0, d, BLOCK_ROWS)]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "data"])

    def add(batches):
        sums = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(data)
        rows = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([sums[b].tobytes() for b in rows], pa.binary())], names=["block", "data"])

    schema = "block int, data binary"
    parts = rows.select("stats", "y").mapInArrow(gather, schema).repartition(-(-d // BLOCK_ROWS), "block").mapInArrow(add, schema)
    whole = np.concatenate([np.frombuffer(r["data"]) for r in sorted(parts.collect(), key=lambda r: r["block"])]).reshape(d, d + 1)
    return whole[:, :d], whole[:, d]


def isotonic(x: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: bin values in order, rows and sum of labels in each; knots of a rising function."""
    blocks: list[list[float]] = []
    for v, m, t in zip(x, n, s):
        blocks.append([v * m, m, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    if not blocks:
        return np.array([LOW, HIGH]), np.array([0.5, 0.5])
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """A model from described() documents (staged) and labels; None without rows of both classes.

    Of the rows that are not held out, three quarters fit the weights and one quarter, told by the
    crc32 of the id, the calibration.
    """
    width = len(STATISTICS)
    rows = staged(stats.join(training_labels(labels, label), "doc_id").select("doc_id", "stats", "y", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4).alias("calibrates")))
    fitted = rows.filter("not calibrates")
    if fitted.select("y").distinct().count() < 2:
        return None
    moments = rows.select([F.avg(F.col("stats")[k]) for k in range(width)] + [F.stddev_pop(F.col("stats")[k]) for k in range(width)]).first()
    model = Model(np.array(moments[:width], float), np.array(moments[width:], float))
    a, b = normal_equations(fitted, model)
    model.weights = np.linalg.solve(a + RIDGE * np.trace(a) / len(a) * np.eye(len(a)), b)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def place(batches):
        for batch in batches:
            raw = sent.value.raw(_matrix(batch.column("stats"), width))
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    binned = rows.filter("calibrates").select("stats", "y").mapInArrow(place, "bin long, y int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    got = sorted(tuple(r) for r in binned.collect())
    if got:
        at, n, s = (np.array(c, float) for c in zip(*got))
        model.steps = isotonic(LOW + (at + 0.5) * (HIGH - LOW) / BINS, n, s)
    return model


def scored(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of described() documents; without a model every score is 0.5."""
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            x = _matrix(batch.column("stats"), len(STATISTICS))
            value = sent.value.score(x) if sent.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(value, 0, 1))], names=["doc_id", "score"])

    out = stats.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score of 0.3 or more) of every document.

    One row for each row of docs, repeated ones too; a null text is empty and scored like an empty one;
    a null doc_id is kept and not held out. Only doc_id and text are read.
    """
    stats = staged(described(docs))
    return scored(stats, fit(stats, labels))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
