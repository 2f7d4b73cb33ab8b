"""Importance resampling towards a target distribution.

1. Words of letters, digits and characters beyond ASCII; features are runs of one and two words, hashed by
   CRC-32 into buckets. A text is an array of bytes: the CRC of every word is the exclusive or of one
   table entry a byte, and that of a pair follows from those of its words, so no feature is made a string.
2. Counts of buckets over all documents and over the target give an array of gains, one a bucket, which
   scores a document by the mean of its features' gains. Only these arrays (``buckets`` numbers) meet in
   the driver.
3. A Gumbel number from the SHA-256 of seed and doc_id is added, so the highest scores are a sample
   drawn without replacement in proportion to the weights.
4. The lowest score drawn is found by bisection of numbers: exact counts over the written scores, at
   ``PROBES`` thresholds a job; ties at that score are cut by a bisection of doc_id in the same way.
5. Drawn rows are range-partitioned; a row's rank is its place in its partition and the rows before it.

No group of rows meets in one task, whatever is equal in them: equal rows are told apart by their place.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .frames import checkpointed, partitions

CHUNK = 1 << 20          # bytes worked on at once
LONG = 255               # longer words take zlib, one by one
PROBES = 15
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
NOT_WORD = re.compile(rb"[\x00-/:-`{-\x7f]")


@functools.cache
def crc_table() -> np.ndarray:
    """Row d + 3: what a byte with d bytes after it adds to a CRC-32 register that started at zero."""
    byte = np.arange(256, dtype=np.uint32)
    step = byte.copy()
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
    rows = [byte << np.uint32(16), byte << np.uint32(8), byte, step]
    while len(rows) < LONG + 5:
        rows.append(step[rows[-1] & np.uint32(255)] ^ (rows[-1] >> np.uint32(8)))
    return np.concatenate(rows)


@functools.cache
def zero_crcs() -> np.ndarray:
    """CRC-32 of 0, 1, 2, ... zero bytes: the part of a CRC that depends on the length alone."""
    return np.array([zlib.crc32(bytes(n)) for n in range(2 * LONG + 2)], np.uint32)


def feature_crcs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, CRC-32 of each word, CRC-32 of each two neighbours joined by a blank) of a lower-cased buffer."""
    data = np.frombuffer(text, np.uint8)
    inside = IN_WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return starts, np.empty(0, np.uint32), np.empty(0, np.uint32)
    table, zeros = crc_table(), zero_crcs()
    letters = data[inside]
    offsets = np.cumsum(sizes) - sizes
    after = np.repeat(offsets + sizes - 1, sizes) - np.arange(len(letters))
    np.minimum(after, LONG, out=after)
    plain = np.bitwise_xor.reduceat(table[((after + 3) << 8) + letters], offsets)
    short = np.minimum(sizes, LONG)
    one = plain ^ zeros[short]
    first, second, n = plain[:-1], plain[1:], short[1:]
    two = second ^ table[((n + 3) << 8) + 32] ^ zeros[short[:-1] + n + 1]
    for j in range(4):
        two ^= table[((n + 3 - j) << 8) + ((first >> np.uint32(8 * j)) & np.uint32(255))]
    word = lambda i: text[starts[i]: starts[i] + sizes[i]]
    for i in np.flatnonzero(sizes > LONG).tolist():
        one[i] = zlib.crc32(word(i))
        for left in {max(i - 1, 0), min(i, len(two) - 1)} if len(two) else ():
            two[left] = zlib.crc32(word(left) + b" " + word(left + 1))
    return starts, one, two


def pieces(texts: Iterable[bytes | None]) -> Iterator[tuple[bytes, list[int], list[int], bool]]:
    """(buffer, where texts start in it, which texts they are, whether its first word was there before).

    Short texts share a buffer of about ``CHUNK`` bytes; a longer one is cut between words, each cut
    repeating the word before it so that no pair is lost.
    """
    held, at, owners, size = [], [], [], 0
    for i, text in enumerate(texts):
        text = (text or b"").translate(LOWER)
        if len(text) > CHUNK:
            begin, carried = 0, b""
            while begin < len(text):
                stop = NOT_WORD.search(text, min(begin + CHUNK, len(text)))
                end = stop.start() if stop else len(text)
                cut = text[begin:end]
                yield carried + b" " + cut, [0], [i], bool(carried)
                found = max((m for m in [_last_word(cut)] if m), default=carried, key=len)
                begin, carried = end, found
            continue
        held.append(text)
        at.append(size)
        owners.append(i)
        size += len(text) + 1
        if size > CHUNK:
            yield b"\n".join(held), at, owners, False
            held, at, owners, size = [], [], [], 0
    if held:
        yield b"\n".join(held), at, owners, False


def _last_word(text: bytes) -> bytes:
    inside = IN_WORD[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(inside)
    if not len(ends):
        return b""
    before = np.flatnonzero(~inside[: ends[-1]])
    return text[(before[-1] + 1 if len(before) else 0): ends[-1] + 1]


def hashed(texts: Iterable[bytes | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each word, its bucket, text of each pair, its bucket), a buffer at a time."""
    for buffer, at, owners, carried in pieces(texts):
        starts, one, two = feature_crcs(buffer)
        owner = np.asarray(owners)[np.searchsorted(at, starts, "right") - 1]
        same = owner[:-1] == owner[1:]
        of_word, of_pair = owner, owner[:-1][same]
        one, two = one % np.uint32(buckets), two[same] % np.uint32(buckets)
        if carried:
            of_word, one = of_word[1:], one[1:]
        yield of_word, one, of_pair, two


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows fall into each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, one, _, two in hashed(batch.column(0).to_pylist(), buckets):
                seen += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = texts.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long")
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.bucket] = row.n
    return out


def gains(all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of smoothed shares of each bucket, floored."""
    n, total, aim = len(all_counts), float(all_counts.sum()), float(target_counts.sum())
    ratio = lambda s, t: (t + 1.0) * (total + n) / ((s + 1.0) * (aim + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(
        all_counts.tolist(), target_counts.tolist(), strict=True)], np.int64)


def array_scored(docs: DataFrame, gain: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, n_words, n_features, weight) of every document; ``row`` is a struct of doc_id and ``keep``."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            n = batch.num_rows
            words, pairs, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for of_word, one, of_pair, two in hashed(batch.column("text").to_pylist(), buckets):
                words += np.bincount(of_word, minlength=n)
                pairs += np.bincount(of_pair, minlength=n)
                np.add.at(total, of_word, value[one])
                np.add.at(total, of_pair, value[two])
            features = words + pairs
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(x, pa.int64()) for x in (words, features, weight))],
                names=["row", "n_words", "n_features", "weight"])

    given = docs.select(F.struct("doc_id", *keep).alias("row"), F.col("text").cast("binary").alias("text"))
    counts = [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]
    return given.mapInArrow(score, T.StructType([given.schema["row"], *counts]))


def gumbel(seed: str, doc_id: Column) -> Column:
    """A thousand times a standard Gumbel number, floored, from the first 32 bits of SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def least_reaching(rows: DataFrame, value: Column, low: int, high: int, need: int) -> int:
    """The smallest whole number v in [low, high] for which ``need`` rows have ``value <= v``; high if none has."""
    while low < high:
        probes = sorted({low + (high - low) * i // (PROBES + 1) for i in range(1, PROBES + 1)})
        counts = rows.agg(*(F.count_if(value <= F.lit(p)).alias(f"p{i}") for i, p in enumerate(probes))).first()
        reached = next((i for i, n in enumerate(counts) if n >= need), len(probes))
        low, high = (probes[reached - 1] + 1 if reached else low), (probes[reached] if reached < len(probes) else high)
    return low


def drawn_rows(scored: DataFrame, wanted: int) -> Column:
    """The condition under which a row of ``scored`` (doc_id, score, eligible) is among the ``wanted`` highest.

    Rows that differ in neither score nor doc_id are all let in when the last place falls on them.
    """
    able = scored.filter("eligible")
    down = -F.col("score")
    ends = able.agg(F.min(down).alias("low"), F.max(down).alias("high")).first()
    cut = least_reaching(able, down, ends.low, ends.high, wanted)
    tied = able.filter(down == cut)
    count = able.agg(F.count_if(down < cut).alias("above")).first()
    ids = tied.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    missing = wanted - count.above
    above = F.col("eligible") & (down < cut)
    at_cut = F.col("eligible") & (down == cut)
    if missing > ids.n:
        return above | at_cut
    last = least_reaching(tied, F.col("doc_id"), ids.low, ids.high, missing)
    return above | (at_cut & F.coalesce(F.col("doc_id") <= last, F.lit(False)))


def importance_ranks(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, buckets: int = 10_000,
                     seed: str = "7", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep``, n_features, weight, score, rank) of every document.

    ``floor(share * N / 100)`` of the N documents with ``least_words`` words or more are drawn; rank is 1 for the
    highest score, ties go to the smaller doc_id, null doc_id last, then to fewer features; it is null for the rest.
    Weights come from the texts of ``target`` against those of all documents.

    Null or empty text: no words, weight 0, never drawn. Null doc_id: hashes as empty text. Very long texts are
    read in buffers of ``CHUNK`` bytes and longer words singly. Rows repeated in full get ranks in any order.
    Empty ``docs``: empty result; empty ``target``: weights from the smoothing alone. Other columns are read
    only if named in ``keep``, and may bear a result's name only if they aren't.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    weighed = array_scored(docs, gain, keep).select(
        F.col("row"), F.col("row.doc_id").alias("doc_id"), "n_features", "weight",
        (F.col("weight") + gumbel(seed, F.col("row.doc_id"))).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"), F.monotonically_increasing_id().alias("at"))
    scored = checkpointed(weighed)
    wanted = share * scored.filter("eligible").count() // 100
    result = [F.col("row.*"), F.col("n_features"), F.col("weight"), F.col("score")]
    if not wanted:
        return scored.select(*result, F.lit(None).cast("long").alias("rank"))
    drawn = drawn_rows(scored, wanted)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("at")]
    placed = checkpointed(
        scored.filter(drawn).repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.join(before, "part").select(*result, F.when(rank <= wanted, rank).alias("rank"))
    rest = scored.filter(~drawn).select(*result, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, **how: object) -> DataFrame:
    """The documents drawn by :func:`importance_ranks`, with all their columns."""
    row = docs.select(F.col("doc_id"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    picked = importance_ranks(row, target, keep=("whole",), **how)
    return picked.filter(F.col("rank").isNotNull()).select("whole.*")
