"""Licence notices in texts: a trained paragraph classifier, with an unknown class and a template comparison.

A softmax regression over hashed one-, two- and three-word grams tells licence families from each other and from
other text. It is trained in numpy on altered copies of the notices below and on a bounded sample of paragraphs of
the corpus. A temperature fitted on altered notices that were not trained on calibrates its probabilities. A
paragraph that looks like a licence has a family if one is likely enough and most word pairs of one of
that family's notices are found in it; with fewer of them it is of unknown licence, without any of none.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf.llm import words as W
from cellsheaf.llm.common import without

#: Notices by family.
NOTICES = {
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or any later version",
    ),
    "lgpl": ("under the terms of the GNU Lesser General Public License", "Licensed under the LGPL, version 2.1"),
    "agpl": ("under the terms of the GNU Affero General Public License", "Licensed under the AGPL, version 3"),
    "apache": ("Licensed under the Apache License, Version 2.0.", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "bsd": ("Licensed under the BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the MPL 2.0"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related rights to this work", "dedicated to the public domain under CC0 1.0 Universal"),
    "proprietary": ("All rights reserved.", "Copyright by the authors. All rights reserved. No part of this publication may be reproduced without written permission"),
}
FAMILIES = tuple(NOTICES)
#: Bits of the gram table; words of a unit; shares of a notice's word pairs that confirm a family and hint at a licence; likelihood of a family; sampled paragraphs.
GRAM_BITS, UNIT_WORDS, CONFIRMED, HINT, LIKELY, SAMPLE = 18, 32, 0.6, 0.15, 0.6, 4000
COPIES, EPOCHS, RATE, SEED = 60, 6, 0.3, 5
OUTPUT = ["licences"]


def grams(h: np.ndarray, part: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3 the table rows of the grams and the words they begin at; a gram stays in its paragraph."""
    out, g = [], h
    for n in (1, 2, 3):
        at = np.flatnonzero(part[: len(h) - n + 1] == part[n - 1 :]) if len(h) >= n else np.zeros(0, np.int64)
        if n > 1:
            g = g[: len(h) - n + 1] * np.uint64(0xD6E8FEB86659FD93) + h[n - 1 :] if len(h) >= n else g[:0]
        out.append(((W.mixed(g[at] + np.uint64(n)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64), at))
    return out


def paragraphs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a column, the paragraph (line) of each, and for each row its first word and first paragraph."""
    data, rows = W.raw(column)
    start, end = W.spans(data, rows)
    lines = np.unique(np.concatenate([rows, np.flatnonzero(data == 10) + 1]))
    return W.hashes(data, start, end), np.searchsorted(lines, start, "right") - 1, np.searchsorted(start, rows), np.searchsorted(lines, rows)


def units(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one word of each unit: a paragraph, or runs of UNIT_WORDS words of a longer one, which overlap by half."""
    if not len(part):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, np.diff(part) != 0))
    last = np.append(first[1:], len(part))
    half = UNIT_WORDS // 2
    n = np.maximum(1, -(-(last - first - half) // half))
    own = np.repeat(np.arange(len(first)), n)
    begin = first[own] + half * (np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n))
    return begin, np.minimum(begin + UNIT_WORDS, last[own])


class Model:
    def __init__(self):
        self.table = np.zeros((1 << GRAM_BITS, len(FAMILIES) + 1), np.float32)
        self.temperature = 1.0
        self.pairs = {}
        for k, family in enumerate(FAMILIES):
            for notice in NOTICES[family]:
                h = W.words(pa.array([notice]))[0]
                self.pairs.setdefault(k, []).append(set(W.shingles(h, 2).tolist()))

    def logits(self, h: np.ndarray, part: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(h) + 1, self.table.shape[1]))
        for rows, at in grams(h, part):
            sums[at + 1] += self.table[rows]
        sums = np.cumsum(sums, axis=0)
        return (sums[end] - sums[begin]) / np.sqrt(np.maximum(end - begin, 1))[:, None]

    def probabilities(self, *given) -> np.ndarray:
        z = self.logits(*given) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return z / z.sum(axis=1, keepdims=True)

    def likeness(self, h: np.ndarray, family: int) -> float:
        """Share of the word pairs of the family's most alike notice that the words hold."""
        own = set(W.shingles(h, 2).tolist())
        return max(len(own & pairs) / len(pairs) for pairs in self.pairs[family])

    def train(self, texts: list[str], y: np.ndarray, epochs: int = EPOCHS) -> None:
        h, at = W.words(pa.array(texts))
        part = np.repeat(np.arange(len(texts)), np.diff(at))
        places = [(rows, part[a]) for rows, a in grams(h, part)]
        rows, owner = np.concatenate([r for r, _ in places]), np.concatenate([o for _, o in places])
        order = np.argsort(owner, kind="stable")
        rows, owner = rows[order], owner[order]
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        scale = 1 / np.sqrt(np.maximum(np.diff(at), 1))
        squares = np.full_like(self.table, 1e-2)
        rng = np.random.default_rng(SEED)
        for _ in range(epochs):
            for own in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 64)):
                take = np.concatenate([np.arange(first[i], first[i + 1]) for i in own])
                local = np.repeat(np.arange(len(own)), first[own + 1] - first[own])
                z = np.zeros((len(own), self.table.shape[1]))
                np.add.at(z, local, self.table[rows[take]])
                z *= scale[own][:, None]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(own)), y[own]] -= 1
                hit, back = np.unique(rows[take], return_inverse=True)
                g = np.zeros((len(hit), self.table.shape[1]), np.float32)
                np.add.at(g, back, (p * scale[own][:, None])[local])
                squares[hit] += g * g
                self.table[hit] -= RATE * g / np.sqrt(squares[hit])

    def calibrate(self, texts: list[str], y: np.ndarray) -> None:
        """The temperature with the least log loss."""
        h, at = W.words(pa.array(texts))
        part = np.repeat(np.arange(len(texts)), np.diff(at))
        z = self.logits(h, part, at[:-1], at[1:])

        def loss(t: float) -> float:
            s = z / t
            return float((np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) - s[np.arange(len(y)), y]).mean())

        self.temperature = min(np.geomspace(0.1, 10, 41), key=loss)


def altered(rng: random.Random, notice: str, filler: list[str]) -> str:
    """A notice with some words lost, added or in capitals, and sometimes with other text around it."""
    out = []
    for w in notice.split():
        if rng.random() >= 0.05:
            out.append(w.upper() if rng.random() < 0.1 else w)
        if rng.random() < 0.05:
            out.append(rng.choice(filler))
    around = [rng.choice(filler) for _ in range(rng.choice((0, 0, 5, 20)))]
    cut = rng.randint(0, len(around))
    return " ".join(around[:cut] + out + around[cut:])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the notices and at most `sample` paragraphs of the corpus that are not like any notice."""
    n = docs.count()
    share = 1_000_000 if n <= sample else max(1, 1_000_000 * sample // n)
    rows = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share)
    line = F.element_at(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"), -1)
    seen = [r["line"] for r in rows.select(F.substring(line, 1, 1000).alias("line")).limit(sample).collect()]
    model, rng = Model(), random.Random(SEED)
    h, at = W.words(pa.array(seen, pa.string()))
    likely = [max(model.likeness(h[i:j], k) for k in range(len(FAMILIES))) for i, j in zip(at, at[1:])]
    other = sorted(t for t, share in zip(seen, likely) if share < CONFIRMED / 2)
    filler = [w for t in other for w in t.split()[:20]] or ["word"]
    parts: dict[bool, list[tuple[str, int]]] = {True: [], False: []}
    known = [w for own in NOTICES.values() for notice in own for w in notice.split()]
    for k, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            for i in range(COPIES):
                parts[i % 4 > 0].append((altered(rng, notice, filler) if i else notice, k))
    for i in range(COPIES * len(FAMILIES)):
        # Single words of notices in other text are no licence.
        mixed = [rng.choice(known) if rng.random() < 0.2 else rng.choice(filler) for _ in range(rng.randint(3, 40))]
        parts[i % 4 > 0].append((" ".join(mixed), len(FAMILIES)))
    for i, t in enumerate(other):
        parts[i % 4 > 0].append((t, len(FAMILIES)))
    model.train([t for t, _ in parts[True]], np.array([k for _, k in parts[True]]))
    model.calibrate([t for t, _ in parts[False]], np.array([k for _, k in parts[False]]))
    return model


def scan(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add licences to each document: its licence paragraphs (number of the line, family, score, likeness), in order.

    score is the likelihood of the family, or for "unknown" that of being any licence. A null or empty
    text has none. Rows may repeat; an input column named licences is replaced.
    """
    docs = without(docs, OUTPUT).withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    item = T.StructType().add("paragraph", "long").add("family", "string").add("score", "double").add("likeness", "double")
    schema = T.StructType([*docs.schema.fields, T.StructField("licences", T.ArrayType(item))])
    kind = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("score", pa.float64()), ("likeness", pa.float64())]))

    def look(batches):
        model = sent.value
        for batch in batches:
            for rows in W.slices(batch, "__text", 1 << 20):
                h, part, at, lines = paragraphs(rows.column("__text"))
                begin, end = units(part)
                p = model.probabilities(h, part, begin, end)
                found: list[dict[int, dict]] = [{} for _ in range(rows.num_rows)]
                for u in np.flatnonzero(p[:, :-1].sum(axis=1) >= 0.5):
                    k = int(p[u, :-1].argmax())
                    alike = model.likeness(h[begin[u] : end[u]], k)
                    if alike < HINT:
                        continue
                    sure = p[u, k] >= LIKELY and alike >= CONFIRMED
                    r = int(np.searchsorted(at, begin[u], "right")) - 1
                    own = {"paragraph": int(part[begin[u]] - lines[r]), "family": FAMILIES[k] if sure else "unknown", "score": float(p[u, k] if sure else p[u, :-1].sum()), "likeness": alike}
                    before = found[r].get(own["paragraph"])
                    # Of the runs of one paragraph, a known family counts before unknown, then the better score.
                    if before is None or (before["family"] == "unknown", own["score"]) > (own["family"] == "unknown", before["score"]):
                        found[r][own["paragraph"]] = own
                lists = pa.array([[f[k] for k in sorted(f)] for f in found], kind)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=schema.names)

    return docs.mapInArrow(look, schema).drop("__text")


def op5_licence(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_licences, families (sorted, comma-joined, unknown among them), best_score (null without any)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = F.col("licences")
    return scan(docs, fit(docs)).select(
        "doc_id",
        F.size(found).cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["family"]))), ",").alias("families"),
        F.array_max(F.transform(found, lambda x: x["score"])).alias("best_score"),
    )
