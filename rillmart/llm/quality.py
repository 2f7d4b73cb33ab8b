"""Quality rules: lines that too many documents of a host share, and counts within a document.

1. Each text is split at line feeds. A line is normalised (runs of white space to one blank, A-Z to lower case,
   runs of digits to one 0) and hashed together with its host; a document holds each of its lines once,
   with the words that all its copies there take.
2. Documents that hold a line are counted by distinct doc_id, first for (line, doc_id), then for the line, so
   a line that every document holds is summed in each task before it is shuffled.
3. Lines of more than ``limit`` documents are removed: the frequent ones meet the documents' lines in a join that
   deals each line over ``SALTS`` keys, and their words are summed for a document.
4. A document is depleted, and rejected, when more than ``most_removed`` percent of its words are gone or fewer than
   ``least_words`` are left. Rules on the document alone (too short, too repetitive) reject it before.

All lines of all documents are counted, those of rejected documents too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import checkpointed
from .words import BASE, BLANK, by_text, mix, word_hashes

LIMIT = 10               # documents of a host that may hold a line
MOST_REMOVED = 50        # percent of a document's words
LEAST_WORDS = 10
MOST_REPEATED = 20       # percent of a document's words
WINDOW = 5
SALTS = 16
SYMBOLS = b"#*$%&|<>"
DIGITS = re.compile(rb"[0-9]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LINES = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())]))


def host_seed(host: str | None) -> int:
    return 0 if host is None else xxhash.xxh64_intdigest(host.encode(), 1)


def line_key(words: list[bytes], seed: int) -> int:
    """Signed 64-bit hash of a normalised line of a host."""
    value = xxhash.xxh64_intdigest(DIGITS.sub(b"0", b" ".join(words).translate(LOWER)), seed)
    return value - (1 << 64) if value >> 63 else value


def line_measures(text: bytes, seed: int) -> tuple[int, int, int, int, dict[int, int]]:
    """(words, their code points, symbols, lines equal to an earlier one, words by line key)."""
    n_words = repeated = 0
    seen: set[bytes] = set()
    held: Counter[int] = Counter()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            n_words += len(words)
            repeated += line in seen
            seen.add(line)
            held[line_key(words, seed)] += len(words)
    letters = text.translate(None, b" \t\n\v\f\r")
    code_points = int((np.frombuffer(letters, np.uint8) & 0xC0 != 0x80).sum())
    return n_words, code_points, len(text) - len(text.translate(None, SYMBOLS)), repeated, held


def repeated_words(hashes: np.ndarray, size: int = WINDOW) -> int:
    """Words of a text that lie in a window of ``size`` words which is found there twice or more."""
    n = len(hashes) - size + 1
    if n < 2:
        return 0
    run = hashes[:n].copy()
    for j in range(1, size):
        run = run * np.uint64(BASE) + hashes[j: n + j]
    _, which, count = np.unique(mix(run), return_inverse=True, return_counts=True)
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(count[which] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measured(docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, the measures, lines) of every document; ``row`` is a struct of doc_id and ``keep``."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            found = [line_measures(t, host_seed(h)) for t, h in zip(texts, batch.column("host").to_pylist(), strict=True)]
            repeats = [repeated_words(h) for h in by_text(*word_hashes(texts, BLANK))]
            plain = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
            lines = pa.array([[{"line": k, "words": n} for k, n in f[4].items()] for f in found],
                             pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *plain, pa.array(repeats, pa.int64()), lines],
                names=["row", *MEASURES, "lines"])

    given = docs.select(F.struct("doc_id", *keep).alias("row"), F.col(host).cast("string").alias("host"),
                        F.col("text").cast("binary").alias("text"))
    counts = [T.StructField(name, T.LongType()) for name in MEASURES]
    return given.mapInArrow(measure, T.StructType([given.schema["row"], *counts, T.StructField("lines", LINES)]))


def frequent_lines(held: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(line, documents) of the lines in more than ``limit`` distinct documents; ``held`` has (line, doc_id).

    All rows without a doc_id count as one document.
    """
    pairs = held.groupBy("line", "doc_id").agg(F.count("*").alias("n"))
    return pairs.groupBy("line").agg(F.count("*").alias("documents")).filter(F.col("documents") > limit)


def salted_lines(held: DataFrame, frequent: DataFrame, salt: Column) -> DataFrame:
    """Rows of ``held`` whose line is frequent; the rows of a line are dealt over ``SALTS`` keys."""
    copies = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return held.withColumn("salt", salt).join(copies, ["line", "salt"])


def judged(docs: DataFrame, host: str = "source", limit: int = LIMIT, most_removed: int = MOST_REMOVED,
           least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep``, the measures, removed_words, removed_lines, base_failed, kept) of every document.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` percent of them in repeated windows.
    ``kept``: not ``base_failed`` and not depleted. ``removed_lines`` are the hashes of its lines above the limit.

    Null or empty text: no words, so ``base_failed``. Null host: a host of its own. Null doc_id: rows are judged singly,
    but count as one document when lines are counted, as do rows of equal doc_id. Very long texts are held a row at a
    time. Empty table: empty result. Other columns are read only if named in ``keep``; they may not bear a result's name.
    """
    rows = checkpointed(measured(docs, host, keep).withColumn("at", F.monotonically_increasing_id()))
    held = rows.select("at", F.col("row.doc_id").alias("doc_id"), F.inline("lines"))
    hit = salted_lines(held.drop("doc_id"), frequent_lines(held.select("line", "doc_id"), limit), F.col("at") % SALTS)
    gone = hit.groupBy("at").agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    left = F.col("n_words") - F.col("removed_words")
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    depleted = (100 * F.col("removed_words") > most_removed * F.col("n_words")) | (left < least_words)
    return (rows.drop("lines").join(gone, "at", "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
            .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<bigint>")))
            .select("row.*", *MEASURES, "removed_words", "removed_lines",
                    base.alias("base_failed"), (~base & ~depleted).alias("kept")))


def cleaned(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """The kept rows of ``docs``, with all their columns, whose texts lack the lines above the limit.

    Column names of ``docs`` may be any: a row travels as one struct.
    """
    whole = docs.select(F.col("doc_id"), F.col("text"), F.col(host).alias("host"),
                        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    kept = judged(whole, "host", keep=("text", "host", "whole"), **limits).filter("kept")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, host_name, gone in zip(*(batch.column(c).to_pylist() for c in ("text", "host", "removed_lines")), strict=True):
                seed, drop = host_seed(host_name), set(gone)
                texts.append(text if not drop else b"\n".join(
                    line for line in text.split(b"\n") if not (words := line.split()) or line_key(words, seed) not in drop))
            yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(texts, pa.binary())], names=["whole", "stripped"])

    given = kept.select("whole", F.col("text").cast("binary").alias("text"), F.col("host").cast("string").alias("host"), "removed_lines")
    out = given.mapInArrow(strip, T.StructType([given.schema["whole"], T.StructField("stripped", T.BinaryType())]))
    return out.select(*(F.col("stripped").cast("string").alias(c) if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns))
