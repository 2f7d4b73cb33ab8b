"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct hashed words, word pairs, and pairs with one or two words
between them. Features are made in parallel; the per-coordinate learner then reads a bounded sample
of labelled documents in one task. L1 leaves few weights other than zero, and those are broadcast:
at most ``1 << BITS`` numbers, however large the corpus. Scoring reads every text where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import BASE, mix, word_hashes

BITS = 20
SKIPS = (1, 2, 3)
SAMPLE = 16_000


def features(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) for every word, neighbouring pair and skip-gram of each text."""
    shift = np.uint64(64 - BITS)
    owner = np.repeat(np.arange(len(counts)), counts)
    found, owners = [hashes >> shift], [owner]
    for gap in SKIPS:
        same = owner[:-gap] == owner[gap:]
        pair = (hashes[:-gap] * np.uint64(BASE) + hashes[gap:] + np.uint64(gap))[same]
        found.append(mix(pair) >> shift)
        owners.append(owner[:-gap][same])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


class Ftrl:
    """Per-coordinate rates with L1 and L2; the last coordinate is the bias, which no penalty shrinks."""

    def __init__(self, size: int, alpha: float = 2.0, beta: float = 0.1, l1: float = 4.0, l2: float = 0.01):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, size

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == self.bias, 0.0, self.l1)
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at.astype(np.int64), self.bias)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, owner = features(*word_hashes(batch.column("text").to_pylist()))
        keys = np.unique(owner << BITS | found)
        cuts = np.searchsorted(keys, np.arange(1, batch.num_rows) << BITS)
        rows = [x.astype("<u4").tobytes() for x in np.split(keys & ((1 << BITS) - 1), cuts)][: batch.num_rows]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("label"), pa.array(rows, pa.binary())],
                                         names=["place", "label", "features"])


def _fit(epochs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(np.frombuffer(f, "<u4"), y) for b in batches
            for f, y in zip(b.column("features").to_pylist(), b.column("label").to_pylist(), strict=True)]
    model = Ftrl(1 << BITS)
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            model.learn(*rows[i])
    w = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], names=["at", "w"])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, sample: int = SAMPLE,
          epochs: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) other than zero, learnt from ``labels.toxic``.

    ``learn_from`` is a condition on doc_id. The fit uses the ``sample`` labelled doc_ids that
    come first by a hash of the doc_id; that is the documented bound of what one task holds. A
    doc_id with several labels counts as toxic if any of them says so; null labels are none.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    place = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label")).withColumn(
        "place", place).orderBy("place", "doc_id").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.select("place", "label", "text").mapInArrow(
        _featurise, "place long, label int, features binary")
    model = rows.repartition(1).sortWithinPartitions("place", "features").mapInArrow(
        lambda it: _fit(epochs, it), "at long, w double").toPandas()
    return model["at"].to_numpy(), model["w"].to_numpy()


def _score(model, carry_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, w = model.value
    table = np.zeros((1 << BITS) + 1)
    table[at] = w
    for batch in batches:
        found, owner = features(*word_hashes(batch.column("__text").to_pylist()))
        some = table[found] != 0
        keys = np.unique(owner[some] << BITS | found[some])
        sums = np.bincount(keys >> BITS, table[keys & ((1 << BITS) - 1)], batch.num_rows) + table[-1]
        scores = pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))), pa.float64())
        rest = [batch.column("__text").cast(pa.string())] if carry_text else []
        yield pa.RecordBatch.from_arrays([batch.column("__row"), *rest, scores],
                                         names=["__row", *(["__text"] if rest else []), "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: tuple[str, ...] = ("doc_id",),
          carry_text: bool = False) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) of every row's whole text.

    Null and empty texts get the score of the bias alone. Repeated rows get equal scores. An empty
    table gives an empty result. Columns not in ``keep`` are not read; one of them called score is
    replaced. ``carry_text`` says that text is among those kept, so that it is sent only once.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)
    plain = [c for c in keep if c not in ("score", "text" if carry_text else "")]
    rows = docs.select(F.struct(*plain).alias("__row"), F.col("text").cast("binary").alias("__text"))
    text = "__text string, " if carry_text else ""
    scored = rows.mapInArrow(lambda it: _score(weights, carry_text, it),
                             f"__row {rows.schema['__row'].dataType.simpleString()}, {text}score double")
    return scored.select(*(F.col("__text").alias(c) if carry_text and c == "text" else F.col("__row")[c].alias(c)
                           for c in keep if c != "score"), "score")


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less than ``below``, with all their columns, whatever their names."""
    weights = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("__row"),
                       F.col("text").cast("binary").alias("__text"))
    fields = [rows.schema["__row"], T.StructField("__text", T.StringType()), T.StructField("score", T.DoubleType())]
    scored = rows.mapInArrow(lambda it: _score(weights, True, it), T.StructType(fields)).filter(F.col("score") < below)
    return scored.select(*(F.col("__text").alias(c) if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns))
