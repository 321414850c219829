"""Toxicity by a convolutional text classifier, trained on all labelled rows and applied to every whole text.

A word is the sum of two rows of hashed embeddings (two hashes, so that words that share one row still
differ). Filters of several widths run over the words, the largest response of each filter
over the whole text is kept, and a linear layer gives the logit. Embeddings start from the
log-odds of their rows. Training deals the labelled rows to shards; in each round every shard takes numpy steps from the same
parameters, and the means of what the shards have moved are the next parameters. For scoring, embeddings and filters are multiplied out beforehand, so a text
costs a few table look-ups a word. Thresholds are set for each language on all labelled rows that were not trained on; the
language comes from function words of the text itself. A score is 0.5 at its language's threshold.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsheaf.llm import words as W
from cellsheaf.llm.common import apart, fits, staged, without
from cellsheaf.llm.labelled import held_out, texts_of, training_labels

#: Labelled rows of a shard. A task holds so many words, or twice so many rows, of a shard at once; more are one more shard.
SHARD_ROWS, SHARD_WORDS = 8192, 1 << 22
#: Words of a batch, beyond which it ends before BATCH rows.
BATCH_WORDS = 1 << 18
#: What Adagrad's sums begin with: so little that the few steps of a shard in a round go as far as those of one long run.
FIRST = 1e-7
#: Sums over shards are taken in whole multiples of 1 / UNIT, so that their order does not matter, and cut in parts of so many.
UNIT, PART = 1 << 30, 8
#: Logits of the rows that set the thresholds are counted in steps of 1 / LOGIT_STEPS, up to LOGIT_MOST either way.
LOGIT_STEPS, LOGIT_MOST = 256, 64
ROWS_BITS, DIM, FILTERS, WIDTHS = 16, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, SMOOTHING, OFTEN = 6, 32, 0.02, 4, 12
#: Function words by language; texts without any take the threshold of all languages.
LANGUAGES = {
    "en": ("the", "of", "and", "to", "that", "is", "was", "with"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "mit", "von"),
    "fr": ("le", "les", "des", "est", "et", "une", "dans", "pas"),
    "es": ("el", "los", "las", "y", "que", "del", "por", "con"),
}
OUTPUT = ["held_out", "score", "predicted", "language"]
_NAMES = [*LANGUAGES, "all"]


def _function_words() -> tuple[np.ndarray, np.ndarray]:
    known = [(w, k) for k, name in enumerate(LANGUAGES) for w in LANGUAGES[name]]
    h = W.words(pa.array([w for w, _ in known]))[0]
    order = np.argsort(h)
    return h[order], np.array([k for _, k in known])[order]


def languages(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of the language of each row, len(LANGUAGES) if it has no function word."""
    known, which = _function_words()
    place = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = np.flatnonzero(known[place] == h)
    row = np.searchsorted(at, hit, "right") - 1
    n = np.bincount(row * len(LANGUAGES) + which[place[hit]], minlength=(len(at) - 1) * len(LANGUAGES)).reshape(-1, len(LANGUAGES))
    return np.where(n.sum(axis=1) > 0, n.argmax(axis=1), len(LANGUAGES))


def buckets(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - ROWS_BITS)).astype(np.int64), ((h >> np.uint64(16)) & np.uint64((1 << ROWS_BITS) - 1)).astype(np.int64)


def packed(h: np.ndarray) -> np.ndarray:
    """Both buckets of each word in 32 bits."""
    i, j = buckets(h)
    return (i << ROWS_BITS | j).astype(np.uint32)


def unpacked(both: np.ndarray) -> np.ndarray:
    """Hashes with the same buckets."""
    both = both.astype(np.uint64)
    return both >> np.uint64(ROWS_BITS) << np.uint64(64 - ROWS_BITS) | (both & np.uint64((1 << ROWS_BITS) - 1)) << np.uint64(16)


def holders(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """How many texts (arrays of word hashes) of each class hold a word of each row of both tables."""
    seen = np.zeros((2, 2, 1 << ROWS_BITS), np.int64)
    for text, label in zip(texts, y):
        for k, rows in enumerate(buckets(text)):
            seen[k, int(label), np.unique(rows)] += 1
    return seen


class Classifier:
    def __init__(self, texts: list[np.ndarray], y: np.ndarray, seed: int = 3):
        """Log-odds start; texts are arrays of word hashes."""
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.05, (2, 1 << ROWS_BITS, DIM)).astype(np.float32)
        self.filters = {w: rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.shift = np.float32(0)
        self.often = np.zeros((2, 1 << ROWS_BITS), bool)
        self.start(holders(texts, y), np.bincount(y, minlength=2))

    def start(self, held: np.ndarray, rows: np.ndarray) -> None:
        """Start from the holders() of all texts and the rows of each class."""
        size = np.maximum(rows, 1)[:, None]
        for k in range(2):
            # Smoothed by as much of each class as it has rows, so that a row never seen starts at 0.
            seen = SMOOTHING * size / size.sum() + held[k]
            self.often[k] = seen.sum(axis=0) >= OFTEN
            odds = np.log(seen[1] / size[1]) - np.log(seen[0] / size[0])
            self.embedding[k, :, 0] = np.clip(odds, -3, 3) / 2
        self.filters[WIDTHS[0]][0, 0, 0] = 1
        self.out[0] = 1

    def responses(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest response of each filter for each row, from the multiplied-out tables."""
        tables = self.tables()
        i, j = buckets(h)
        g = tables[0][i] + tables[1][j]
        n, out, col = len(h), [], 0
        rows = np.flatnonzero(np.diff(at))
        last = np.zeros(n + 1, bool)
        last[at[1:]] = True
        for w in WIDTHS:
            z = g[:, col : col + FILTERS].copy()
            end = np.zeros(n, bool)
            for k in range(1, w):
                # Words k behind, as long as no row ends before them.
                end[: n - k + 1] |= last[k : n + 1]
                part = g[k:, col + k * FILTERS : col + (k + 1) * FILTERS]
                z[: n - k] += np.where(end[: n - k, None], 0, part)
            col += w * FILTERS
            best = np.zeros((len(at) - 1, FILTERS), np.float32)
            if len(rows):
                best[rows] = np.maximum(np.maximum.reduceat(z, at[rows], axis=0) + self.bias[w], 0)
            out.append(best)
        return np.concatenate(out, axis=1)

    def tables(self) -> list[np.ndarray]:
        if not hasattr(self, "_tables"):
            self._tables = [np.concatenate([e @ self.filters[w][k] for w in WIDTHS for k in range(w)], axis=1) for e in self.embedding]
        return self._tables

    def logits(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.responses(h, at) @ self.out + self.shift

    def train(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed=4, rows: np.ndarray | None = None, squares: dict | None = None) -> np.ndarray:
        """Adagrad on the log loss, both classes weighing the same. Only the words with the largest response take part in a step.

        Texts are packed(). `rows` of each class are those of the whole table (of y if None), `squares` the sums that
        Adagrad goes on from; they are added to. Rows of words that fewer than about OFTEN texts hold keep their start,
        or single texts would be learnt by heart. Returns the steps that each row of the embeddings took part in.
        """
        rng = np.random.default_rng(seed)
        rows = np.bincount(y, minlength=2) if rows is None else rows
        weight = (0.5 * rows.sum() / np.maximum(rows, 1))[y]
        squares = self.squares() if squares is None else squares
        steps = np.zeros((2, 1 << ROWS_BITS), np.int64)
        pad = max(WIDTHS) - 1
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for own in batches_of(order, np.array([len(t) for t in texts])[order]):
                size = np.array([max(1, len(texts[i])) for i in own])
                begin = np.cumsum([0, *(size + pad)])
                i, j = np.zeros(begin[-1], np.int64), np.zeros(begin[-1], np.int64)
                real = np.zeros(begin[-1], bool)
                for r, t in enumerate(own):
                    span = slice(begin[r], begin[r] + len(texts[t]))
                    i[span], j[span] = buckets(unpacked(texts[t]))
                    real[span] = True
                x = (self.embedding[0, i] + self.embedding[1, j]) * real[:, None]
                top, best = {}, []
                for w in WIDTHS:
                    z = sum(x[k : len(x) - w + 1 + k] @ self.filters[w][k] for k in range(w)) + self.bias[w]
                    top[w] = np.array([s + z[s : s + n].argmax(axis=0) for s, n in zip(begin[:-1], size)])
                    best.append(np.maximum(np.take_along_axis(z, top[w], axis=0), 0))
                pooled = np.concatenate(best, axis=1)
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.shift, -30, 30)))
                d = ((p - y[own]) * weight[own] / len(own)).astype(np.float32)
                step = {"out": pooled.T @ d + 1e-4 * self.out, "shift": np.float32(d.sum())}
                moved = np.zeros_like(x)
                for n, w in enumerate(WIDTHS):
                    back = d[:, None] * self.out[n * FILTERS : (n + 1) * FILTERS] * (best[n] > 0)
                    step[f"bias{w}"] = back.sum(axis=0)
                    grad = np.empty_like(self.filters[w])
                    for k in range(w):
                        grad[k] = np.einsum("rfd,rf->df", x[top[w] + k], back)
                        np.add.at(moved, top[w] + k, back[:, :, None] * self.filters[w][k].T[None])
                    step[f"filters{w}"] = grad
                for name, g in step.items():
                    squares[name] += g * g
                    self._set(name, self._parameters()[name] - RATE * g / np.sqrt(squares[name]))
                hit = np.flatnonzero(np.any(moved != 0, axis=1) & real)
                for k, places in ((0, i[hit]), (1, j[hit])):
                    often = self.often[k, places]
                    own_rows, back = np.unique(places[often], return_inverse=True)
                    g = np.zeros((len(own_rows), DIM), np.float32)
                    np.add.at(g, back, moved[hit[often]])
                    squares["embedding"][k, own_rows] += g * g
                    self.embedding[k, own_rows] -= RATE * g / np.sqrt(squares["embedding"][k, own_rows])
                    steps[k, own_rows] += 1
        self.__dict__.pop("_tables", None)
        return steps

    def squares(self) -> dict:
        return {k: np.full_like(v, FIRST) for k, v in self._parameters().items()}

    def weights(self, steps: np.ndarray, rows: int) -> np.ndarray:
        """How much what a shard has moved counts, for each value of flat(): the steps of an embedding's row, else the shard's rows."""
        more = sum(np.size(v) for v in self._parameters().values()) - len(steps) * DIM
        return np.concatenate([np.repeat(steps, DIM), np.full(more, rows)])

    def _parameters(self) -> dict:
        return {"embedding": self.embedding, "out": self.out, "shift": np.float32(self.shift)} | {f"bias{w}": self.bias[w] for w in WIDTHS} | {f"filters{w}": self.filters[w] for w in WIDTHS}

    def _set(self, name: str, value) -> None:
        if name.startswith("bias"):
            self.bias[int(name[4:])] = value
        elif name.startswith("filters"):
            self.filters[int(name[7:])] = value
        else:
            setattr(self, name, value)


def batches_of(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of BATCH rows; one ends before that at BATCH_WORDS words, but has a row at least."""
    at = 0
    while at < len(order):
        n = max(1, int((np.cumsum(sizes[at : at + BATCH]) <= BATCH_WORDS).sum()))
        yield order[at : at + n]
        at += n


def flat(values: dict) -> np.ndarray:
    """All parameters (or their squares) in one row; the embeddings come first."""
    return np.concatenate([np.ravel(v) for v in values.values()]).astype(np.float64)


def shaped(row: np.ndarray, like: dict) -> dict:
    at = np.cumsum([0, *(np.size(v) for v in like.values())])
    return {k: row[a:b].reshape(np.shape(v)).astype(np.float32) for (k, v), a, b in zip(like.items(), at, at[1:])}


PARTS = "part long, " + ", ".join(f"v{k} long" for k in range(PART))


def parts(row: np.ndarray) -> pa.RecordBatch:
    """The parts of a row of whole numbers that are not all 0."""
    cut = np.append(row, np.zeros(-len(row) % PART, np.int64)).reshape(-1, PART)
    at = np.flatnonzero(cut.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(cut[at, k]) for k in range(PART))], names=["part", *(f"v{k}" for k in range(PART))])


def total(pieces: DataFrame, length: int) -> np.ndarray:
    """Sum of rows that came as parts(). What is collected has the size of one row."""
    got = pieces.groupBy("part").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(PART)]).toArrow()
    out = np.zeros((-(-length // PART), PART), np.int64)
    for k in range(PART):
        out[got["part"].to_numpy(), k] = got[f"v{k}"].to_numpy()
    return out.ravel()[:length]


def best_threshold(logit: np.ndarray, y: np.ndarray, clean_cost: float = 1.0, n: np.ndarray | None = None) -> float:
    """The middle of the gap with the least cost of wrong rows, a toxic row costing 1; of equally good gaps the widest. 0 without both classes.

    Each value stands for n rows (1 if None).
    """
    n = np.ones(len(y)) if n is None else n
    if not (y == 1).any() or not (y == 0).any():
        return 0.0
    order = np.argsort(logit)
    v, label, n = logit[order], y[order], n[order]
    wrong = np.append(0, np.cumsum(n * (label == 1))) + clean_cost * np.append(np.cumsum((n * (label == 0))[::-1])[::-1], 0)
    v = np.concatenate([[v[0] - 2], v, [v[-1] + 2]])
    gap = np.diff(v)
    wrong = np.where(gap > 0, wrong, np.inf)
    k = np.flatnonzero(wrong == wrong.min())
    k = k[gap[k].argmax()]
    return float((v[k] + v[k + 1]) / 2)


def labelled_words(docs: DataFrame, labels: DataFrame, label: str, shard_rows: int) -> DataFrame:
    """shard, doc_id, y, calibrates, language and packed words of every document to learn from, dealt to shards by a hash of the id.

    A quarter of the ids, told by their crc32, calibrates. The order of a shard's rows follows from their ids.
    """
    chosen = staged(training_labels(labels, label))
    n = chosen.count()
    shards = max(1, -(-n // shard_rows))

    def hashed(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                h, at = W.words(part.column("text"))
                both = packed(h)
                data = pa.array([both[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(languages(h, at), pa.int32()), data], names=["doc_id", "y", "language", "words"])

    if few := fits(n, 24):
        rows = texts_of(docs, chosen)
    else:  # Dealt by id before they meet, which puts each shard in one partition.
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(~held_out())
        rows = texts_of(ids.repartition(shards, "doc_id"), chosen.repartition(shards, "doc_id"))
    rows = rows.mapInArrow(hashed, "doc_id long, y int, language int, words binary")
    rows = rows.withColumns({"shard": F.pmod(F.hash("doc_id"), F.lit(shards)), "calibrates": F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4})
    rows = rows.repartition(shards, "shard") if few else rows
    return staged(rows.sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id", "words"))


def words_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(w.as_buffer(), np.uint32) for w in column]


def shards_of(batches) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Shard, packed texts and classes of the rows of each shard that follow each other, in pieces that a task can hold."""
    shard, texts, y, size = None, [], [], 0
    for batch in batches:
        for s, label, text in zip(batch.column("shard").to_pylist(), batch.column("y").to_pylist(), words_of(batch.column("words"))):
            if texts and (s != shard or size + len(text) > SHARD_WORDS or len(texts) >= 2 * SHARD_ROWS):
                yield shard, texts, np.array(y)
                texts, y, size = [], [], 0
            shard = s
            texts.append(text.copy())
            y.append(label)
            size += len(text)
    if texts:
        yield shard, texts, np.array(y)


def trained(rows: DataFrame, size: np.ndarray) -> Classifier:
    """A classifier from all rows (shard, y, words), size[y] of each class.

    In each of EPOCHS rounds every shard trains a copy once over its rows. The new parameters are the means of
    the shards' own, weighted by their rows, and for a row of the embeddings by the steps that it took part in.
    """
    context = rows.sparkSession.sparkContext

    def count(batches):
        for _, texts, y in shards_of(batches):
            yield parts(holders((unpacked(t) for t in texts), y).ravel())

    model = Classifier([], np.zeros(0, np.int64))
    model.start(total(rows.mapInArrow(count, PARTS), 4 << ROWS_BITS).reshape(2, 2, -1), size)
    squares = model.squares()
    n = 2 << ROWS_BITS
    for epoch in range(EPOCHS):
        sent = context.broadcast((model, squares))

        def learn(batches, sent=sent, epoch=epoch):
            for piece, (shard, texts, y) in enumerate(shards_of(batches)):
                start, sums = sent.value
                own, added = copy.deepcopy((start, sums))
                steps = own.train(texts, y, 1, (epoch, shard, piece), size, added).ravel()
                weight = own.weights(steps, len(texts))
                moved = [np.rint((flat(b) - flat(a)) * weight * UNIT).astype(np.int64) for a, b in ((start._parameters(), own._parameters()), (sums, added))]
                yield parts(np.concatenate([*moved, steps, [len(texts)]]))

        old = flat(model._parameters())
        got = total(rows.mapInArrow(learn, PARTS), 2 * len(old) + n + 1)
        weight = model.weights(got[-n - 1 : -1], got[-1]) * float(UNIT)
        mean = lambda moved: np.divide(moved, weight, out=np.zeros(len(moved)), where=weight > 0)
        for name, value in shaped(old + mean(got[: len(old)]), model._parameters()).items():
            model._set(name, value)
        squares = shaped(flat(squares) + mean(got[len(old) : 2 * len(old)]), squares)
        sent.destroy()
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", shard_rows: int = SHARD_ROWS) -> tuple[Classifier | None, np.ndarray]:
    """A classifier and the threshold of each language (and of all), from every labelled document and its whole text.

    Three quarters of the rows train the classifier, the others set the thresholds. If there are not both
    classes to train on, there is no classifier and every score is 0. The driver gets sums whose sizes are
    those of the classifier's tables and of the logit steps.
    """
    rows = labelled_words(docs, labels, label, shard_rows)
    n = {(r["calibrates"], r["y"]): r["count"] for r in rows.groupBy("calibrates", "y").count().collect()}
    size = np.array([n.get((False, y), 0) for y in range(2)])
    if not size.all():
        return None, np.zeros(len(_NAMES))
    model = trained(rows.filter("not calibrates").select("shard", "y", "words"), size)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def place(batches):
        for batch in batches:
            texts = words_of(batch.column("words"))
            got = np.zeros(len(texts))
            # Few rows at a time: the look-ups of a word take far more memory than the word.
            for own in batches_of(np.arange(len(texts)), np.array([len(t) for t in texts])):
                h = unpacked(np.concatenate([texts[i] for i in own]))
                got[own] = sent.value.logits(h, np.cumsum([0, *(len(texts[i]) for i in own)]))
            step = np.rint(np.clip(got, -LOGIT_MOST, LOGIT_MOST) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("language"), batch.column("y"), pa.array(step)], names=["language", "y", "step"])

    counts = rows.filter("calibrates").select("language", "y", "words").mapInArrow(place, "language int, y int, step int").groupBy("language", "y", "step").count()
    spoken, y, step, weight = (np.array(c, np.int64) for c in (zip(*sorted(tuple(r) for r in counts.collect())) if len(n) > 2 else [[]] * 4))
    logit = step / LOGIT_STEPS
    # A toxic row costs 1. A clean one costs the square root of the toxic rows for each clean one, at any size of the table: between
    # few wrong rows in all (1) and as few lost of either class (their ratio).
    clean, toxic = (sum(n.get((c, k), 0) for c in (True, False)) for k in range(2))
    cost = float(np.sqrt(min(1.0, toxic / clean)))
    whole = best_threshold(logit, y, cost, weight)
    thresholds = []
    for k in range(len(_NAMES)):
        own = spoken == k
        enough = weight[own & (y == 1)].sum() >= 10 and weight[own & (y == 0)].sum() >= 10
        thresholds.append(best_threshold(logit[own], y[own], cost, weight[own]) if enough else whole)
    return model, np.array(thresholds)


def score_toxicity(docs: DataFrame, model: Classifier | None, thresholds: np.ndarray) -> DataFrame:
    """Add held_out, score, predicted and language to every document.

    A null text is empty; an empty text has the score of no response. Input columns named like an output are
    replaced. Rows may repeat; a null doc_id is not held out.
    """
    docs = without(docs, OUTPUT)
    sent = docs.sparkSession.sparkContext.broadcast((model, thresholds))
    rows = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("score", F.lit(0.0)).withColumn("language", F.lit(""))

    def score(batches):
        model, thresholds = sent.value
        for batch in batches:
            for part in W.slices(batch, "__text", 1 << 20):
                h, at = W.words(part.column("__text"))
                spoken = languages(h, at)
                logit = model.logits(h, at) - thresholds[spoken] if model else np.full(len(at) - 1, -np.inf)
                value = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
                names = pa.array([_NAMES[k] for k in spoken], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(value.astype(np.float64) * bool(model)), names], names=part.schema.names)

    out = rows.mapInArrow(score, rows.schema).drop("__text")
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns], held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The documents that are not toxic, with their own columns; the classifier learns from `training` (docs if None)."""
    held, restore = apart(docs, OUTPUT)
    return restore(score_toxicity(held, *fit(docs if training is None else training, labels)).filter("predicted = 0"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_toxicity(docs, *fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).drop("text")
