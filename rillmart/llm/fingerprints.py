"""Document fingerprints: a homomorphic multiset hash of paragraphs (lines).

A paragraph hashes to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane, modulo a power of two. Sums commute, so the order of paragraphs does not matter, and
paragraphs are inserted into or deleted from a fingerprint without the rest of the text.

- ``EXACT`` lanes modulo 2 ** 64 add up hashes of whole paragraphs: equal multisets of paragraphs
  have equal lanes, others collide with chance 2 ** -256.
- ``LANES`` lanes modulo 2 ** 32 add up the paragraph's pieces, runs of ``PIECE`` words, each as +1 or -1 in
  the lane that its hash names. The normalised inner product of two such vectors estimates the
  cosine of the multisets of pieces, with a standard error of ``LANES ** -0.5`` at most.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import partitions
from .words import mix, shingle_hashes, word_hashes

EXACT = 4
LANE_BITS = 7
LANES = 1 << LANE_BITS
PIECE = 3

Vectors = tuple[np.ndarray, np.ndarray]      # exact lanes (uint64), piece lanes (uint32), a row for each text


def vectors(texts: list[bytes]) -> Vectors:
    """The fingerprints of whole texts."""
    parts = [t.split(b"\n") for t in texts]
    each = np.array([len(p) for p in parts], np.int64)
    lines = [x for p in parts for x in p]
    owner = np.repeat(np.arange(len(texts)), each)
    wide = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x, seed) for x in lines for seed in (1, 2)), np.uint64)
    exact = np.zeros((len(texts), EXACT), np.uint64)
    if len(lines):
        exact[:] = np.add.reduceat(wide.reshape(-1, EXACT), np.cumsum(each) - each)
    hashes, counts = word_hashes(lines)
    pieces, runs = shingle_hashes(hashes, counts, PIECE)
    short = np.flatnonzero((counts > 0) & (counts < PIECE))     # a line of fewer words is one piece
    firsts = (np.cumsum(counts) - counts)[short]
    lasts = firsts + counts[short] - 1
    pieces = np.concatenate([pieces, mix(hashes[firsts] + hashes[lasts] * np.uint64(3) + counts[short].astype(np.uint64))])
    text = np.concatenate([np.repeat(owner, runs), owner[short]])
    lane = (pieces >> np.uint64(64 - LANE_BITS)).astype(np.int64)
    sign = 1.0 - 2.0 * ((pieces & np.uint64(1)).astype(np.float64))
    sums = np.bincount(text * LANES + lane, sign, len(texts) * LANES).astype(np.int64)
    return exact, (sums.reshape(-1, LANES) & 0xFFFFFFFF).astype(np.uint32)


def insert(a: Vectors, b: Vectors) -> Vectors:
    """The fingerprints of ``a`` with the paragraphs of ``b`` added."""
    return a[0] + b[0], a[1] + b[1]


def delete(a: Vectors, b: Vectors) -> Vectors:
    """The fingerprints of ``a`` with the paragraphs of ``b`` taken away."""
    return a[0] - b[0], a[1] - b[1]


def likeness(a: Vectors, b: Vectors) -> np.ndarray:
    """0 to 1, row by row: 1 for equal fingerprints, else the estimated cosine of the pieces."""
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.clip((x * y).sum(axis=1) / np.where(size > 0, size, 1), 0, 1)
    return np.where((a[0] == b[0]).all(axis=1), 1.0, cosine)


def packed(v: Vectors) -> list[str]:
    """Base64 of the exact lanes and the piece lanes, little-endian."""
    return [base64.b64encode(e.astype("<u8").tobytes() + n.astype("<u4").tobytes()).decode()
            for e, n in zip(*v, strict=True)]


def unpacked(values: list[str]) -> Vectors:
    raw = np.frombuffer(b"".join(map(base64.b64decode, values)), np.uint8).reshape(len(values), -1)
    return (np.ascontiguousarray(raw[:, : 8 * EXACT]).view("<u8"), np.ascontiguousarray(raw[:, 8 * EXACT:]).view("<u4"))


def fingerprints(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, fingerprint string) of every row's whole text; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = packed(vectors([t or b"" for t in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.string())],
                                             names=[b.schema.names[0], "fingerprint"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"`{id_column}` {kind}, fingerprint string")


def with_followers(docs: DataFrame, spread: int = 4) -> DataFrame:
    """Rows (bucket, guest, doc_id, sign, text): sorted in each bucket, each row before its next.

    Buckets are ranges of doc_id cut at approximate quantiles. The first row of every bucket is also a
    guest at the end of the one before (the first of all: of the last), so that every own row
    is followed by the next document without a global window. The driver sees one id for each bucket.
    """
    spark = docs.sparkSession
    n = spread * partitions(spark)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i: i + step] for i in range(0, len(cuts), step)]

    def below(values: list) -> F.Column:
        return F.size(F.filter(F.array(*map(F.lit, values)).cast("array<long>"), lambda x: x <= F.col("doc_id")))

    bucket = F.lit(0)
    if cuts:
        block = below([b[0] for b in blocks])
        inner = F.element_at(F.array(*(F.array(*map(F.lit, b)).cast("array<long>") for b in blocks)), F.greatest(block, F.lit(1)))
        bucket = F.when(block == 0, 0).otherwise(
            (block - 1) * step + F.size(F.filter(inner, lambda x: x <= F.col("doc_id"))))
    bucket = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(bucket).cast("int")
    keyed = rows.select(bucket.alias("own"), "doc_id", F.xxhash64("text").alias("sign"), "text")
    firsts = sorted(keyed.groupBy("own").agg(F.min(F.struct("doc_id", "sign")).alias("k")).collect(), key=lambda r: r["own"])
    first_id, first_sign, before = ([None] * (len(cuts) + 2) for _ in range(3))
    for i, r in enumerate(firsts):
        first_id[r["own"]], first_sign[r["own"]] = r["k"]["doc_id"], r["k"]["sign"]
        before[r["own"]] = firsts[i - 1]["own"]

    def of_own(values: list, kind: str) -> F.Column:
        return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("own") + 1)

    is_first = F.col("doc_id").eqNullSafe(of_own(first_id, "long")) & (F.col("sign") == of_own(first_sign, "long"))
    places = F.when(is_first, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
                                      F.struct(of_own(before, "int").alias("bucket"), F.lit(True).alias("guest")))
                    ).otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))))
    placed = keyed.withColumn("at", F.explode(places)).select("at.bucket", "at.guest", "doc_id", "sign", "text")
    return placed.repartition(partitions(spark), "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").asc_nulls_last(), "sign")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None          # (bucket, guest, doc_id, text, vectors) of the last row
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = batch.column("text").to_pylist()
        own = vectors(raw)
        rows = list(zip(batch.column("bucket").to_pylist(), batch.column("guest").to_pylist(),
                        batch.column("doc_id").to_pylist(), (t.decode("utf-8", "replace") for t in raw), strict=True))
        if held is not None:
            rows.insert(0, held[:4])
            own = tuple(np.concatenate([h, o]) for h, o in zip(held[4], own, strict=True))
        held = (*rows[-1], tuple(x[-1:].copy() for x in own))
        at = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        edited, tails, new_tails = [], [], []
        for i in at:
            text, follower = rows[i][3], rows[i + 1][3]
            keep = len(text) - len(text) // 4
            edited.append(text[:keep] + follower[: len(text) // 4])
            line = text.rfind("\n", 0, keep) + 1
            tails.append(text[line:].encode("utf-8", "replace"))
            new_tails.append(edited[-1][line:].encode("utf-8", "replace"))
        mine, following = tuple(x[at] for x in own), tuple(x[[i + 1 for i in at]] for x in own)
        changed = insert(delete(mine, vectors(tails)), vectors(new_tails))
        yield pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in at], pa.int64()), pa.array([len(rows[i][3]) for i in at], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited], pa.string()),
            pa.array(packed(mine), pa.string()), pa.array(packed(changed), pa.string()),
            pa.array(likeness(mine, changed), pa.float64()), pa.array(likeness(mine, following), pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document.

    The edited text has the last quarter of its characters replaced by the first as many of the next
    document by doc_id (nulls last, ties by a hash of the text; after the last: the first). Its
    fingerprint is made incrementally: the lines from the cut on are deleted, the new ones inserted.

    Null text: empty, with n_chars 0. Equal texts have equal fingerprints. A single row is its own next.
    An empty table gives an empty result. Only doc_id and text are read.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_followers(docs).mapInArrow(_edits, schema)
