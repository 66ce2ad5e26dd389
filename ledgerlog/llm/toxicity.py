"""Toxicity by multiple-instance learning: documents are bags of sentences.

Only documents have labels. A sentence scores s = sigmoid(bias + weights of its words). With
leak = sigmoid(bias), the document scores 1 - (1 - leak) * product of (1 - s) / (1 - leak) over the
sentences with s > leak: a noisy-or whose leak counts once a document, so that sentences without
evidence add nothing, however many there are. The weights follow from the likelihood of the
document labels, so blame falls on the sentences that explain them; these are reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import hashed_sample, pieces

PER_LABEL = 3000
LEAST_DOCS = 12
FLOOR = 3
LEAST_SHARE = 0.04
LEAST_DEVIATION = 5.0
PREFIXES = (3, 4, 5, 6, 7, 8)
STEPS = 400
RATE = 0.1
PENALTY = 1e-5
THRESHOLD = 0.7
SENTENCE = 0.5
KEPT_WORDS = 250_000
NEVER = -30.0
HIGHEST_LEAK = -4.0

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, which inflected forms share."""
    return [f"={word}", *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]


def sentences_of(text: str | None) -> list[tuple[int, int, set[str]]]:
    """Begin, end and distinct words of each sentence that has words."""
    found = []
    for m in _SENTENCE.finditer(text or ""):
        words = set(_WORD.findall(m[0].lower()))
        if words:
            found.append((m.start(), m.end(), words))
    return found


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature in a partition, by label."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            words = set(_WORD.findall((text or "").lower()))
            for f in {f for w in words for f in features_of(w)}:
                counts.setdefault(f, [0, 0])[label] += 1
    keys = list(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), *(pa.array([counts[k][i] for k in keys], pa.int64()) for i in (0, 1))],
        ["feature", "clean", "toxic"])


def _bagged(index):
    """Per document: label, number of sentences, and (sentence, feature, count) of the chosen features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                sentences = sentences_of(text)
                cells: dict[tuple[int, int], int] = {}
                for i, (_, _, words) in enumerate(sentences):
                    for w in words:
                        for f in features_of(w):
                            if (k := known.get(f)) is not None:
                                cells[i, k] = cells.get((i, k), 0) + 1
                rows.append({"label": label, "n": len(sentences),
                             "cells": [v for (i, k), c in cells.items() for v in (i, k, c)]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("label", pa.int32()), ("n", pa.int32()), ("cells", pa.list_(pa.int32()))]))

    return run


def support(n0: int, n1: int) -> int:
    """Documents a feature must be found in: a share of the rarer label's, ``FLOOR`` to ``LEAST_DOCS``."""
    return max(FLOOR, min(LEAST_DOCS, ceil(LEAST_SHARE * min(n0, n1))))


def fit(labels: np.ndarray, sizes: np.ndarray, cells: list[list[int]], n_features: int) -> tuple[float, np.ndarray]:
    """Bias and weights of highest penalised likelihood of the document labels, by Adam.

    Both labels weigh the same, but the bias stays at ``HIGHEST_LEAK`` or below, since its sigmoid is what
    a document scores without evidence. Without features, nothing is toxic.
    """
    bags = sizes > 0
    labels, sizes, cells = labels[bags].astype(float), sizes[bags], [c for c, b in zip(cells, bags) if b]
    if not len(labels) or not n_features:
        return NEVER, np.zeros(n_features)
    heads = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    flat = [np.array(c, np.int64).reshape(-1, 3) + [[head, 0, 0]] for c, head in zip(cells, heads)]
    row, col, count = np.concatenate(flat).T
    balance = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    theta = np.zeros(n_features + 1)
    theta[-1] = min(-6.0, HIGHEST_LEAK)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        evidence = np.bincount(row, count * theta[col], len(doc))
        told = evidence >= 0
        z = np.clip(evidence + theta[-1], -30, 30)
        s = np.where(told, 1 / (1 + np.exp(-z)), 0.0)
        leak = 1 / (1 + np.exp(-theta[-1]))
        base = np.logaddexp(0, theta[-1])
        clean = -base - np.add.reduceat(np.where(told, np.logaddexp(0, z) - base, 0.0), heads)
        p = np.clip(-np.expm1(clean), 1e-12, 1)
        pull = np.where(labels == 1, np.exp(clean) / p, -1.0) * balance
        slope = pull[doc] * s
        of_bias = slope.sum() - leak * (pull[doc] * told).sum() + leak * pull.sum()
        gradient = np.append(np.bincount(col, count * slope[row], n_features), of_bias)
        gradient[:-1] -= PENALTY * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta[-1] = min(theta[-1], HIGHEST_LEAK)
    return float(theta[-1]), theta[:-1]


class Model:
    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights = bias, weights
        self.kept: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.kept.get(word)
        if found is None:
            found = sum(self.weights.get(f, 0.0) for f in features_of(word))
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            if len(word) <= 64:
                self.kept[word] = found
        return found

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """The document's score and the sentences that score ``SENTENCE`` or more."""
        text, blamed = text or "", []
        if not _WORD.search(text):
            return 0.0, blamed
        base, weight = float(np.logaddexp(0, self.bias)), self.weight
        clean = -base
        if not any(map(weight, set(_WORD.findall(text.lower())))):
            return float(-np.expm1(clean)), blamed
        for begin, end, words in sentences_of(text):
            evidence = sum(map(weight, words))
            if evidence <= 0:
                continue
            z = min(30.0, self.bias + evidence)
            clean -= float(np.logaddexp(0, z)) - base
            if z >= 0:
                blamed.append({"begin": begin, "end": end, "score": float(1 / (1 + np.exp(-z)))})
        return float(-np.expm1(clean)), blamed


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          usable: Column | None = None, per_label: int = PER_LABEL) -> Model:
    """A model of at most ``per_label`` labelled documents of each label, chosen by a hash of their keys.

    ``usable`` is a condition on the labels' rows. Features are words and word beginnings found in
    ``support`` of the documents, ``FLOOR`` of them with the label they speak for, whose toxic share is
    ``LEAST_DEVIATION`` standard deviations off. Labels other
    than 0 and 1, NULL keys and labels without a document teach nothing; of repeated labels of a
    document the largest counts. Without both labels or without features every score is near 0.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    known = (labels.where(F.lit(True) if usable is None else usable)
             .select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
             .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    chosen = hashed_sample(known.join(texts.select("id").distinct(), "id"), "label", "id", per_label)
    sample = texts.join(F.broadcast(chosen), "id").select("text", "label")  # at most 2 * per_label rows
    sizes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model(NEVER, {})
    both = F.col("clean") + F.col("toxic")
    counts = (sample.mapInArrow(_seen, "feature string, clean bigint, toxic bigint").groupBy("feature")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(both >= support(n0, n1)))
    expected = both * n1 / (n0 + n1)
    deviation = F.abs(F.col("toxic") - expected) / (F.sqrt(both * n0 * n1) / (n0 + n1))
    backed = F.when(F.col("toxic") > expected, F.col("toxic")).otherwise(F.col("clean")) >= FLOOR
    telling = counts.where((deviation >= LEAST_DEVIATION) & backed).select("feature")
    names = sorted(r["feature"] for r in telling.toLocalIterator())
    index = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})
    bags = sample.mapInArrow(_bagged(index), "label int, n int, cells array<int>").toArrow()
    bias, weights = fit(bags.column("label").to_numpy(), bags.column("n").to_numpy(),
                        bags.column("cells").to_pylist(), len(names))
    return Model(bias, {f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-3})


def _scored(shared, names: list[str], again: str | None):
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, "text"):
            found = [model.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column("text" if n == again else n) for n in names), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([b for _, b in found], kind)], [*names, "score", "sentences"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, then ``score``, ``predicted`` (1 from ``THRESHOLD`` on) and ``sentences``.

    ``sentences`` are the [begin, end) character ranges of sentences that score ``SENTENCE`` or
    more. NULL and wordless texts score 0, texts without evidence the sigmoid of the bias, whatever their length. Repeated rows stay; other columns are ignored; an empty
    table gives an empty result.
    """
    names = [f"c{i}" for i in range(len(keep))]
    again = next((n for c, n in zip(keep, names) if c == text), None)  # a kept text is sent to the task once
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names) if n != again),
                       F.col(f"`{text}`").alias("text"))
    kinds = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names))).schema.fields
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kinds]
                       + ["score double", "sentences array<struct<begin: int, end: int, score: double>>"])
    out = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model), names, again), schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "sentences")
