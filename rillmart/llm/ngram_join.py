"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word n-grams, as 64-bit hashes; the global order of n-grams is that
of their hashes, which cuts into fragments of equal share without counting.

1. Equal sets are one class; classes join, documents don't.
2. Candidates. Two sets of together s n-grams that reach similarity t differ in at most
   ``s (1 - t) / (1 + t)`` n-grams. The order is cut into more fragments than that (finer for larger
   sets, by size class), so one fragment at least is equal in both. Classes meet by the hash of a fragment.
   If a set has more non-empty fragments than may differ, its empty ones need no row.
3. In a bucket of equal fragments, every class is paired only with the one that shares most fragments
   with others, which of near copies is the least edited. What these links connect needs no more pairs.
   Buckets in which several components are left then pair their classes across components.
   Pairs whose histograms over the order rule the similarity out are dropped before.
4. Partial overlaps: every pair's two sets are cut into ``VERTICAL`` fragments of the order;
   each fragment's overlap is counted apart, then summed over the pair: the exact intersection.
   Only the sets of candidates are shuffled; a bitmap of bounded size finds their texts in one more
   reading, and what it lets through besides is dropped by a join.

No link between different texts is lost: a pair not verified lies within one component. Groups of near
copies cost rows in proportion to their size, not to its square.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .frames import checkpointed, partitions
from .words import by_text, mix, shingle_hashes, word_hashes

VERTICAL = 8
BINS = 256
HELD = 2_000_000         # keys that a task holds before it sends or gives them
PAGE = 32_768            # bits of one page of a bitmap
MOST_BITS = 1 << 29      # of the bitmap of candidates that is broadcast: 64 MB at most
CROWD = 2_000            # classes of one bucket that are compared in one group


class Sizes:
    """Size classes, half as large again each, with the fragments that similarity ``least / 100`` needs."""

    def __init__(self, least: int, longest: int = 1 << 40):
        self.least, self.starts = least, [1]
        while self.starts[-1] < longest:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 3 // 2))

    def may_differ(self, both: int) -> int:
        """Most n-grams in one of two sets only, given the sum of the sizes."""
        return both * (100 - self.least) // (100 + self.least)

    def classes(self, n: int) -> list[tuple[int, int, int]]:
        """(class, n-grams that may differ, fragments) under which a set of ``n`` meets others."""
        own = bisect_right(self.starts, n) - 1
        last = bisect_right(self.starts, n * 100 // self.least) - 1
        differ = [(c, self.may_differ(2 * (self.starts[c + 1] - 1))) for c in range(own, last + 1)]
        return [(c, d, d + d // 6 + 2) for c, d in differ if d]


def sets_of(texts: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; a shorter text is one n-gram, no word none."""
    hashes, counts = word_hashes(texts)
    grams, runs = shingle_hashes(hashes, counts, k)
    for words, own in zip(by_text(hashes, counts), by_text(grams, runs), strict=True):
        if len(words) and not len(own):
            own = np.array([len(words)], np.uint64)
            for w in words:
                own = mix(own * np.uint64(31) + w)
        yield np.unique(own)


def class_of(grams: np.ndarray) -> int:
    """The identity of a set, as a signed 64-bit number."""
    return int(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))])).view(np.int64)[0])


def fragment_keys(grams: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Hashes of the fragments under which the set meets others."""
    found = []
    for kind, differ, fragments in sizes.classes(len(grams)):
        place = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        if len(starts) > differ:
            sums, at = np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), starts), place[starts]
        else:
            sums, at = np.zeros(fragments, np.uint64), np.arange(fragments, dtype=np.uint64)
            sums[place[starts].astype(np.int64)] = np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), starts)
        found.append(mix(sums + mix(at + np.uint64(kind << 40))))
    return np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)


def _members(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(sets_of(batch.column("text").to_pylist(), k))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("sign"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())],
            names=["doc_id", "sign", "n_shingles", "class"])


def _keys(k: int, least: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs (bucket, keys, classes, counts) of the fragment keys of distinct sets.

    A key's high half names its bucket, its low half is sent: 4 bytes, with 9 more for a set and bucket.
    Two keys that agree by chance cost a candidate, which is verified like others.
    """
    sizes = Sizes(least)
    found: dict[int, np.ndarray] = {}

    def packs() -> pa.RecordBatch:
        keys = np.concatenate(list(found.values())).view(np.uint64)
        of = np.repeat(np.fromiter(found, np.int64, len(found)), [len(x) for x in found.values()])
        found.clear()
        bucket = keys >> np.uint64(32)
        bucket *= np.uint64(buckets)
        bucket = (bucket >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, of, bucket = keys.astype("<u4")[order], of[order], bucket[order]
        new = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (of[1:] != of[:-1])))
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(keys)))
        bounds = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        cuts, runs = np.append(bounds, len(keys)), np.searchsorted(heads, np.append(bounds, len(keys)))
        rows = [(int(bucket[i]), keys[i:j].tobytes(), of[heads[r:q]].tobytes(), counts[r:q].astype("<u4").tobytes())
                for i, j, r, q in zip(cuts[:-1], cuts[1:], runs[:-1], runs[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
            names=["bucket", "keys", "classes", "counts"])

    held = 0
    for batch in batches:
        for grams in sets_of(batch.column("text").to_pylist(), k):
            if len(grams) and (of := class_of(grams)) not in found and len(keys := fragment_keys(grams, sizes)):
                found[of] = keys
                held += len(keys)
        if held > HELD:
            yield packs()
            held = 0
    if held:
        yield packs()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of packs sorted by bucket: (key, class) for the keys that several classes share, each once.

    When more than ``HELD`` keys of a bucket are held, the shared ones are given and one row is kept for each
    key, so a key that very many classes share takes one row's memory.
    """
    number, held, size = None, [], 0

    def given() -> tuple[pa.RecordBatch | None, tuple]:
        key, of, done = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((~done, of, key))
        key, of, done = key[order], of[order], done[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])))
        key, of, done = key[new], of[new], done[new]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        several = ~first | np.append(~first[1:], False)
        some = several & ~done
        rows = pa.RecordBatch.from_arrays([pa.array((number << 32) + key[some].astype(np.int64)), pa.array(of[some])],
                                          names=["key", "class"]) if some.any() else None
        return rows, (key[first], of[first], (done | several)[first])

    for batch in batches:
        for r in batch.to_pylist():
            if r["bucket"] != number or size > HELD:
                if held:
                    rows, rest = given()
                    if rows is not None:
                        yield rows
                    held, size = ([], 0) if r["bucket"] != number else ([rest], 0)
                number = r["bucket"]
            keys = np.frombuffer(r["keys"], "<u4")
            of = np.repeat(np.frombuffer(r["classes"], np.int64), np.frombuffer(r["counts"], "<u4"))
            held.append((keys, of, np.zeros(len(keys), bool)))
            size += len(keys)
    if held:
        rows, _ = given()
        if rows is not None:
            yield rows


def is_marked(marks: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Which of ``spots`` are set in a bitmap of packed bytes."""
    return (marks[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 > 0


def _candidates(k: int, wanted, parts: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows whose ``spot`` is marked in the bitmap ``wanted``: class, size, and histogram or parts of the set."""
    for batch in batches:
        batch = batch.filter(pa.array(is_marked(wanted.value, batch.column("spot").to_numpy())))
        sets = [s for s in sets_of(batch.column("text").to_pylist(), k) if len(s)]
        bins = [np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=BINS) for s in sets]
        if parts:
            cuts = [np.concatenate(([0], np.cumsum(b)))[:: BINS // VERTICAL] for b in bins]
            last = pa.array([[s.view(np.int64)[i:j] for i, j in zip(c[:-1], c[1:], strict=True)]
                             for s, c in zip(sets, cuts, strict=True)], pa.list_(pa.list_(pa.int64())))
        else:      # counts beyond 16 bits only make the bound weaker
            last = pa.array([np.minimum(b, 32767).tolist() for b in bins], pa.list_(pa.int16()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), last],
            names=["class", "n", "parts" if parts else "bins"])


def _across(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, low, high): pairs of different components that may be similar enough.

    A group holds two parts of a bucket, or one part twice named; pairs are made between the parts.
    """
    held, names = None, ("key", "low", "high", "part", "class", "component", "n")

    def pairs(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        new = np.zeros(len(rows["key"]), bool)
        for c in ("key", "low", "high"):
            new[1:] |= rows[c][1:] != rows[c][:-1]
        cuts = np.concatenate(([0], np.flatnonzero(new), [len(new)]))
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            of, side, part, n, bins = (rows[c][start:end] for c in ("class", "part", "component", "n", "bins"))
            two = rows["low"][start] != rows["high"][start]
            for i in range(end - start - 1):
                other = np.flatnonzero((part[i + 1:] != part[i]) & ((side[i + 1:] != side[i]) | ~two)) + i + 1
                apart = np.abs(bins[other] - bins[i]).sum(axis=1)
                some = other[apart * (100 + least) <= (n[other] + n[i]) * (100 - least)]
                if len(some):
                    yield np.minimum(of[i], of[some]), np.maximum(of[i], of[some])

    def out(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(rows["key"]) and (found := list(pairs(rows))):
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy() for c in names}
        rows["bins"] = batch.column("bins").flatten().to_numpy().astype(np.int32).reshape(batch.num_rows, BINS)
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
        same = np.ones(len(rows["key"]), bool)
        for c in ("key", "low", "high"):
            same &= rows[c] == rows[c][-1]
        at = int(np.flatnonzero(same)[0])
        yield from out({c: v[:at] for c, v in rows.items()})
        held = {c: v[at:] for c, v in rows.items()}
    if held is not None:
        yield from out(held)


def similar_enough(pairs: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose histograms allow the similarity, with the sum of their sizes."""
    ends = pairs.join(sketches.toDF("a", "na", "bins_a"), "a").join(sketches.toDF("b", "nb", "bins_b"), "b")
    apart = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda s, x: s + x)
    both = F.col("na") + F.col("nb")
    return ends.filter(apart * (100 + least) <= both * (100 - least)).select("a", "b", both.alias("both"))


def verified(near: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs whose similarity reaches ``least`` percent, by partial overlaps of each fragment, summed."""
    cut = near.join(sets.select(F.col("class").alias("a"), F.col("parts").alias("parts_a")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("parts").alias("parts_b")), "b")
    partial = F.zip_with("parts_a", "parts_b", lambda x, y: F.size(F.array_intersect(x, y)).cast("long"))
    inner = F.aggregate(partial, F.lit(0).cast("long"), lambda s, x: s + x)
    return cut.select("a", "b", "both", inner.alias("inner")).filter(
        100 * F.col("inner") >= least * (F.col("both") - F.col("inner"))).select("a", "b")


def bitmap(rows: DataFrame, spot: Column, bits: int) -> np.ndarray:
    """``bits`` bits, set at the ``spot`` of each row: so many bytes, however many rows."""
    pages = rows.select(spot.alias("spot")).groupBy((F.col("spot") / PAGE).cast("int").alias("page")).agg(
        F.bitmap_construct_agg(F.col("spot") % PAGE).alias("map")).collect()
    out = np.zeros(-(-bits // PAGE) * PAGE // 8, np.uint8)
    for r in pages:
        out[r["page"] * PAGE // 8: (r["page"] + 1) * PAGE // 8] = np.frombuffer(r["map"], np.uint8)
    return out


def marked_spots(rows: DataFrame, *key: str) -> tuple[int, Broadcast]:
    """(bits, bitmap) of the hashes of ``key`` in ``rows``: 64 bits for a row, at most ``MOST_BITS``."""
    bits = PAGE
    while bits < min(MOST_BITS, 64 * rows.count()):
        bits *= 2
    return bits, rows.sparkSession.sparkContext.broadcast(bitmap(rows, spot_of(bits, *key), bits))


def spot_of(bits: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(bits))


def jaccard_components(docs: DataFrame, k: int = 5, least: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, sign, is_first) of every row: groups of texts linked by similarity.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. The set of a text is its
    distinct runs of ``k`` words; with fewer words, the whole sequence as one. Two rows link when
    100 * intersection >= ``least`` * union. ``component_id`` is the smallest doc_id reachable by links;
    ``is_first`` marks its row (ties by ``sign``, a hash of the text; equal rows alike).

    Null texts and those without a word have an empty set (n_shingles 0), link with nothing and are their own
    component. Repeated rows link with each other. A null doc_id is never the smallest unless
    all of its component are null. Empty table: empty result. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("sign"), F.col("text").cast("binary").alias("text"))
    members = checkpointed(texts.mapInArrow(
        lambda it: _members(k, it), f"doc_id {kind}, sign long, n_shingles long, class long"))
    groups = class_components(texts, members, k, least)
    named = members.join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sign")
    firsts = named.filter(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.min(row).alias("first"))
    grouped = named.filter(F.col("component").isNotNull()).join(firsts, "component").select(
        "doc_id", "n_shingles", "component_id", "sign", (row == F.col("first")).alias("is_first"))
    alone = named.filter(F.col("component").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "sign", F.lit(True).alias("is_first"))
    return grouped.unionByName(alone)


def without_near_duplicates(docs: DataFrame, k: int = 5, least: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that of smallest doc_id (nulls last, ties by
    a hash of the text; of equal rows any). Rows without a word are in no group and stay. All columns are kept, whatever
    their names. Rows that a bitmap shows to be in no group stay where they are; only the others' texts are shuffled.
    """
    key = ["sign", "id", "no_id"]

    def keyed(sign: Column, *more: Column | str) -> list[Column | str]:
        return [sign.alias("sign"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), *more]

    rows = jaccard_components(docs, k, least).filter(F.col("n_shingles") > 0).select(*keyed(F.col("sign"), "is_first"))
    marks = checkpointed(rows.groupBy(*key).agg(F.count("*").alias("times"), F.min("is_first").alias("first")).filter(
        ~F.col("first") | (F.col("times") > 1)), few=True)
    bits, marked = marked_spots(marks, *key)

    @F.pandas_udf("boolean")
    def may_go(spot: pd.Series) -> pd.Series:
        return pd.Series(is_marked(marked.value, spot.to_numpy()))

    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    placed = docs.select(*keyed(F.xxhash64("text"), whole)).withColumn("doubt", may_go(spot_of(bits, *key)))
    doubtful = placed.filter("doubt").join(marks, key, "left").filter(F.coalesce("first", F.lit(True)))
    again = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    judged = doubtful.withColumn("again", again).filter(F.col("times").isNull() | (F.col("again") == 1))
    return placed.filter("not doubt").select("whole").unionByName(judged.select("whole")).select("whole.*")


def class_components(texts: DataFrame, members: DataFrame, k: int, least: int) -> DataFrame:
    """(class, component) of every class that links with another."""
    spread = partitions(texts.sparkSession)
    packs = texts.select("text").mapInArrow(
        lambda it: _keys(k, least, spread, it), "bucket int, keys binary, classes binary, counts binary")
    buckets = checkpointed(packs.repartition(spread, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _shared, "key long, class long"))
    wanted = buckets.groupBy("class").agg(F.count("*").alias("shared"))
    first = members.join(wanted.select("class"), "class", "left_semi").groupBy("class").agg(F.min(F.struct("doc_id", "sign")).alias("first"))
    chosen = checkpointed(first.select("class", F.col("first.doc_id").alias("first_id"), F.col("first.sign").alias("sign")), few=True)

    def sets(classes: DataFrame, parts: bool) -> DataFrame:
        bits, marked = marked_spots(chosen.join(classes, "class", "left_semi"), "first_id", "sign")
        last = "parts array<array<long>>" if parts else "bins array<short>"
        found = texts.select(spot_of(bits, "doc_id", "sign").alias("spot"), "text").mapInArrow(
            lambda it: _candidates(k, marked, parts, it), f"class long, n long, {last}")
        return found.repartition(spread, "class").join(classes, "class", "left_semi").dropDuplicates(["class"])

    def links_of(pairs: DataFrame) -> DataFrame:
        near = checkpointed(similar_enough(pairs, sketches, least), few=True)
        ends = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        return checkpointed(verified(near, sets(ends, parts=True), least), few=True)

    sketches = checkpointed(sets(wanted.select("class"), parts=False))
    centres = buckets.join(wanted, "class").groupBy("key").agg(F.max(F.struct("shared", "class")).getField("class").alias("centre"))
    stars = buckets.join(centres, "key").filter(F.col("class") != F.col("centre")).select(
        F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    links = links_of(stars)
    parts = checkpointed(components(links), few=True)
    placed = buckets.select("key", "class").join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    open_keys = placed.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count("*") / CROWD).alias("parts")).filter(
        F.col("x") != F.col("y")).select("key", "parts")
    crowd = placed.join(open_keys, "key").withColumn("part", F.pmod(F.xxhash64("class"), "parts")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = crowd.join(sketches, "class").select(
        "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "class", "component", "n", "bins")
    more = groups.repartition(spread, "key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(
        lambda it: _across(least, it), "a long, b long").distinct()
    all_links = links.unionByName(links_of(more))
    return components(all_links).withColumnRenamed("node", "class")
