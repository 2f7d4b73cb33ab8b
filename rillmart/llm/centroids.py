"""Centroid clustering of vectors by equal-average equal-variance nearest neighbour search, in whole numbers.

Components are ``floor(scale * x)``. Centroids are kept in the order of their component sums. A vector starts at the
centroids whose sums are next to its own and goes outward, one step to either side at a time:

* a side is closed at the first centroid with ``(sum_x - sum_c)^2 >= n * best``: no other on that side is nearer;
* a centroid with ``(sum_x - sum_c)^2 + n^2 * (dev_x - dev_c)^2 >= n^2 * best / n`` is skipped, ``dev`` being the standard
  deviation of the components (a small margin allows for its rounding, so that nothing nearer is skipped);
* all others get the exact squared distance in integers; ties go to the centroid of smaller number.

A round is one reading of the vectors: a task sums the components of its vectors by centroid, so ``k`` rows of a task
meet in the sums by centroid and component. Only the ``k`` centroids are in the driver or broadcast. The assignment is
written once, and sums of distances come from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import checkpointed

SCALE = 256
BOUND = 1 << 26          # larger components count as this, so that squared distances fit 64 bits
BLOCK = 8192             # vectors searched at once
MARGIN = 1e-9


def whole_numbers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have ``size`` finite components, those rows as integers)."""
    long_enough = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    rows = np.flatnonzero(long_enough.to_numpy(zero_copy_only=False))
    flat = column.filter(long_enough).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    good = np.isfinite(flat).all(axis=1)
    return rows[good], np.clip(np.floor(SCALE * flat[good]), -BOUND, BOUND).astype(np.int64)


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and standard deviation of the components of each row."""
    return x.sum(axis=1), x.astype(np.float64).std(axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the centroid nearest to each vector."""
    n, size = vectors.shape
    sums, deviations = moments(centroids)
    order = np.argsort(sums, kind="stable")
    sums, deviations, sorted_centroids = sums[order], deviations[order], centroids[order]
    own_sum, own_deviation = moments(vectors)
    start = np.searchsorted(sums, own_sum)
    best = np.full(n, np.iinfo(np.int64).max, np.int64)
    number = np.full(n, len(centroids), np.int64)

    def visit(who: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Compares vectors ``who`` with centroids ``at``; returns which of them may go on in this direction."""
        apart = (own_sum[who] - sums[at]).astype(np.float64) ** 2
        limit = best[who].astype(np.float64)
        on = apart * (1 - MARGIN) <= size * limit
        spread = size * (own_deviation[who] - deviations[at]) ** 2
        test = on & ((apart / size + spread) * (1 - MARGIN) <= limit)
        look, where = who[test], at[test]
        difference = vectors[look] - sorted_centroids[where]
        distance = np.einsum("ij,ij->i", difference, difference)
        name = order[where]
        nearer = (distance < best[look]) | ((distance == best[look]) & (name < number[look]))
        best[look[nearer]], number[look[nearer]] = distance[nearer], name[nearer]
        return who[on]

    up, down = np.arange(n), np.arange(n)
    step = 0
    while len(up) or len(down):
        up = up[start[up] + step < len(centroids)]
        up = visit(up, start[up] + step)
        step += 1
        down = down[start[down] - step >= 0]
        down = visit(down, start[down] - step)
    return number, best


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows that take part, their integers) of each batch, at most ``BLOCK`` rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            part = batch.slice(begin, BLOCK)
            rows, numbers = whole_numbers(part.column(part.schema.get_field_index(column)), size)
            if len(rows):
                yield part.take(pa.array(rows)), numbers


def first_centroids(vectors: DataFrame, k: int, seed: str, size: int, column: str, key: str) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``seed:key``; equal keys by components. Fewer where there are fewer."""
    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole in blocks(batches, column, size):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole.tolist(), pa.list_(pa.int64()))], names=["hash", "numbers"])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    found = vectors.select(digest.alias("hash"), column).mapInArrow(numbers, "hash string, numbers array<long>")
    rows = found.orderBy("hash", "numbers").limit(k).collect()
    return np.array([r.numbers for r in rows], np.int64).reshape(-1, size)


def moved(vectors: DataFrame, centroids: np.ndarray, column: str) -> np.ndarray:
    """Each centroid replaced by the floored mean of its vectors, exact; those without any stay."""
    k, size = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for _, whole in blocks(batches, column, size):
            number, _ = nearest(whole, shared.value)
            order = np.argsort(number, kind="stable")
            there, begin = np.unique(number[order], return_index=True)
            sums[there] += np.add.reduceat(whole[order], begin, axis=0)
            counts += np.bincount(number, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = vectors.select(column).mapInArrow(partial, "cluster int, n long, sums array<long>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part")).groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("part"), F.sum("n").alias("n"))
    new = centroids.copy()
    for row in totals.collect():
        new[row.cluster, row.place] = int(row.part) // row.n
    return new


def signature(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2", size: int = 64,
              column: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, np.ndarray]:
    """((key, cluster, distance) of every vector that takes part, written once; the final centroids).

    A vector takes part if it has exactly ``size`` components, none null or not finite; components of more than
    ``BOUND`` in either direction count as ``BOUND``. Null keys hash as empty text; repeated rows are vectors like others.
    Empty table, or none that takes part: empty result, no centroids. Other columns are not read.
    """
    given = vectors.select(key, column)
    centroids = first_centroids(given, k, seed, size, column, key)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(given, centroids, column)
        if (after == centroids).all():
            break
        centroids = after
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole in blocks(batches, column, size):
            number, distance = nearest(whole, shared.value)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                                             names=[key, "cluster", "distance"])

    fields = [given.schema[key], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    return checkpointed(given.mapInArrow(assign, T.StructType(fields))), centroids


def cluster_report(vectors: DataFrame, **how: object) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Parameters and odd rows as in :func:`clustered`. Sums of distances that pass 64 bits are null.
    """
    assigned, centroids = clustered(vectors, **how)
    per_cluster = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    looked_up = lambda kind, values: F.element_at(
        F.from_json(F.lit(str(values).replace("None", "null").replace("'", '"')), f"array<{kind}>"), F.col("cluster") + 1)
    inertia: Column = F.lit(fits(sum(per_cluster.values()))).cast("bigint")
    return assigned.select(
        assigned.columns[0], "cluster", "distance",
        looked_up("bigint", [fits(per_cluster.get(i, 0)) for i in range(len(centroids))]).alias("cluster_inertia"),
        inertia.alias("inertia"), looked_up("string", [signature(c) for c in centroids]).alias("centroid_sha256"))
