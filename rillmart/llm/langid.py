"""Language ID by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three lower-cased characters hash to ``SIZE`` buckets. Document frequencies come
from all documents that may be learnt from. Follow-the-regularised-leader with L1 and L2 (elastic
net) fits the weights on a bounded sample, balanced over languages; a fifth of it sets the
temperature that calibrates the scores. The model, ``SIZE`` weights for each language, is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import checkpointed

BITS = 15
SIZE = 1 << BITS
SAMPLE = 6_000
SALTS = 32
UNDETERMINED = "und"


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1- to 3-grams of the whole text, as floats."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = c * np.uint32(0x9E3779B1)
    two = (c[:-1] ^ (c[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + c[2:]
    shift = np.uint32(32 - BITS)
    grams = np.concatenate([c >> shift, (two * np.uint32(0x27D4EB2F)) >> shift, (three * np.uint32(0x165667B1)) >> shift])
    return np.bincount(grams, minlength=SIZE)


def decoded(values: list[bytes | None]) -> list[str | None]:
    return [None if v is None else v.decode("utf-8", "replace") for v in values]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(SIZE, np.int64), 0
    for batch in batches:
        for text in decoded(batch.column("text").to_pylist()):
            seen += ngram_counts(text) > 0
            n += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(seen[at], n), pa.int64())],
                                     names=["at", "n"])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray          # buckets x languages, with the IDF multiplied in
    idf: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        some = counts[at].astype(np.float32)
        norm = np.linalg.norm(some * self.idf[at])
        return (some @ self.weights[at]) / max(norm, 1e-9) + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int, alpha: float = 2.0,
             beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after ``epochs`` passes over rows of (buckets, values, language)."""
    z, n = np.zeros((SIZE + 1, languages)), np.zeros((SIZE + 1, languages))

    def weights(at) -> np.ndarray:
        some = z[at]
        l1s = np.where(np.asarray(at) == SIZE, 0.0, l1)[:, None]
        return np.where(np.abs(some) <= l1s, 0.0, (np.sign(some) * l1s - some) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            at, x, language = rows[i]
            at, x = np.append(at, SIZE), np.append(x, 1.0)
            w = weights(at)
            wrong = softmax(x @ w)
            wrong[language] -= 1
            g = x[:, None] * wrong[None, :]
            before = n[at]
            z[at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / alpha * w
            n[at] = before + g * g
    w = weights(np.arange(SIZE + 1))
    return w[:-1], w[-1]


def calibrated(logits: np.ndarray, languages: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(languages)), languages]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, step = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, n = [], []
        for text in decoded(batch.column("text").to_pylist()):
            counts = ngram_counts(text)
            some = np.flatnonzero(counts)
            at.append(some.astype("<u2").tobytes())
            n.append(counts[some].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("lang"), pa.array(at, pa.binary()), pa.array(n, pa.binary())],
            names=["place", "lang", "at", "n"])


def _fit(idf, epochs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    idf, read = idf.value, []
    for b in batches:
        read += zip(b.column("lang").to_pylist(), b.column("at").to_pylist(), b.column("n").to_pylist(), strict=True)
    languages = sorted({lang for lang, _, _ in read})
    rows = []
    for lang, at, n in read:
        at = np.frombuffer(at, "<u2").astype(np.int64)
        x = np.frombuffer(n, "<f4") * idf[at]
        rows.append((at, x / max(np.linalg.norm(x), 1e-9), languages.index(lang)))
    if languages:
        tune = rows[::5] if len(rows) >= 50 else rows
        fit = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows
        w, bias = fit_ftrl(fit, len(languages), epochs)
        t = calibrated(np.array([x @ w[at] + bias for at, x, _ in tune]), np.array([y for _, _, y in tune]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(languages), pa.array([x.astype("<f4").tobytes() for x in w.T], pa.binary()),
             pa.array(bias, pa.float64()), pa.array([t] * len(languages), pa.float64())],
            names=["lang", "w", "bias", "t"])


def train(docs: DataFrame, learn_from: Column | None = None, sample: int = SAMPLE, epochs: int = 3) -> Model:
    """The model learnt from rows with text and lang for which ``learn_from`` holds.

    Frequencies cover all such rows. The fit uses at most ``sample`` of them, chosen by a hash of
    doc_id, the languages taking turns; that is the documented bound of what one task holds.
    """
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    spark = docs.sparkSession
    texts = known.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    counted = {r["at"]: r["n"] for r in texts.select("text").mapInArrow(_frequencies, "at long, n long")
               .groupBy("at").agg(F.sum("n").alias("n")).collect()}
    seen = np.zeros(SIZE)
    n = counted.pop(-1, 0)
    seen[list(counted)] = list(counted.values())
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    totals = checkpointed(known.groupBy("lang").count(), few=True)
    enough = 2.0 * sample / max(1, totals.count()) / F.col("count")      # twice a language's part of the sample
    shares = totals.select("lang", enough.alias("share"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    place = F.xxhash64(F.lit("language"), "doc_id")
    placed = known.select("doc_id", "lang", place.alias("place"), F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("salt")).join(
        shares, ["lang", "salt"]).filter(F.pmod("place", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = placed.withColumn("turn", turn).orderBy("turn", "place", "lang").limit(sample).select(
        "doc_id", "lang", "place").distinct()
    rows = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).select("place", "lang", "text").mapInArrow(
        _sampled, "place long, lang string, at binary, n binary")
    shared = spark.sparkContext.broadcast(idf)
    model = rows.repartition(1).sortWithinPartitions("place", "lang", "at").mapInArrow(
        lambda it: _fit(shared, epochs, it), "lang string, w binary, bias double, t double").collect()
    w = np.stack([np.frombuffer(r["w"], "<f4") for r in model], 1) if model else np.zeros((SIZE, 0), np.float32)
    return Model([r["lang"] for r in model], (w * idf[:, None]).astype(np.float32), idf,
                 np.array([r["bias"] for r in model]), model[0]["t"] if model else 1.0)


def _predict(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    for batch in batches:
        languages, scores = [], []
        for text in decoded(batch.column("text").to_pylist()):
            if text is None or not m.languages or not any(map(str.isalpha, text)):
                languages.append(UNDETERMINED)
                scores.append(0.0)
                continue
            p = softmax(m.logits(ngram_counts(text)) / m.temperature)
            best = int(p.argmax())
            languages.append(m.languages[best])
            scores.append(float(p[best]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                                         names=[batch.schema.names[0], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score 0 to 1) of every row's whole text.

    Null text or one without a letter, and every text if nothing was learnt: ``und`` with score
    0. Ties go to the first language in code point order. Repeated rows get equal results, an
    empty table an empty one. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda it: _predict(shared, it), f"doc_id {kind}, lang_pred string, score double")
