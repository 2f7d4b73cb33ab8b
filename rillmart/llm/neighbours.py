"""Approximate nearest neighbours by a forest of random-projection trees.

- The forest is grown on the driver from a bounded sample: a node splits at the median of the
  projection on the difference of two random sample vectors, down to ``LEAF`` sample vectors.
- Every vector is filed under its leaf in every tree.
- A query walks all trees through one priority queue ordered by the largest margin by which it
  missed a leaf's side, and takes the first ``probes`` leaves.
- Leaves and queries meet by leaf; all vectors of a leaf are ranked by exact distance, in double
  precision. Leaves of more than ``BLOCK`` vectors are cut into blocks, which the queries visit.
- ``probes`` is the least number that found ``RECALL`` of the true neighbours of up to ``PROBED``
  queries, whose neighbours are first found by brute force over all vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import checkpointed, partitions

TREES, LEAF, SAMPLE = 8, 128, 20_000
PROBED, RECALL = 100, 0.97
BLOCK = 20_000


@dataclass
class Tree:
    """Inner nodes: direction, threshold, children; a child below 0 is leaf ``-1 - child``."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def route(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64) if len(self.children) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            right = (vectors[inner] * self.directions[node]).sum(axis=1) > self.thresholds[node]
            at[inner] = self.children[node, right.astype(np.int64)]
        return -1 - at


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    directions, thresholds, children, leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        for _ in range(3 if len(rows) > leaf else 0):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            if (length := np.linalg.norm(a - b)) > 0:
                place = (sample[rows] * ((a - b) / length)).sum(axis=1)
                low = place <= np.median(place)
                if min(low.sum(), (~low).sum()) * 4 >= len(rows):
                    split = ((a - b) / length, float(np.median(place)), rows[low], rows[~low])
                    break
        if split is None:
            node, leaves = -1 - leaves, leaves + 1
        else:
            node = len(children)
            directions.append(split[0])
            thresholds.append(split[1])
            children.append([0, 0])
            todo += [(split[2], node, 0), (split[3], node, 1)]
        if parent is not None:
            children[parent][side] = node
    dim = sample.shape[1]
    return Tree(np.array(directions).reshape(-1, dim), np.array(thresholds),
                np.array(children, np.int64).reshape(-1, 2), leaves)


@dataclass
class Forest:
    trees: list[Tree]

    @property
    def width(self) -> int:
        return max(t.leaves for t in self.trees)

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf numbers, a column for each tree; numbers of different trees differ."""
        return np.stack([t.route(vectors) + i * self.width for i, t in enumerate(self.trees)], axis=1)

    def probe(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves that the shared queue yields."""
        margins = [t.directions @ query - t.thresholds for t in self.trees]
        queue = [(0.0, i, 0 if len(t.children) else -1) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < most:
            missed, i, node = heapq.heappop(queue)
            while node >= 0:
                m = margins[i][node]
                near, far = (1, 0) if m > 0 else (0, 1)
                heapq.heappush(queue, (max(missed, abs(m)), i, int(self.trees[i].children[node, far])))
                node = int(self.trees[i].children[node, near])
            found.append(i * self.width - 1 - node)
        return found


def matrix(batch: pa.RecordBatch, name: str = "embedding") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vector: str) -> Column:
    """Neither null nor zero, and every component there and finite."""
    v = F.col(vector)
    return (v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


class Nearest:
    """The ``k`` least (distance, id) of each query, of all offered so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.size = k, [], 0

    def offer(self, query: int, ids: np.ndarray, distances: np.ndarray) -> None:
        if len(ids) > self.k:
            limit = np.partition(distances, self.k - 1)[self.k - 1]
            some = distances <= limit
            ids, distances = ids[some], distances[some]
        self.rows.append((np.full(len(ids), query), ids, distances))
        self.size += len(ids)
        if self.size > 1 << 20:
            kept = self.best()
            self.rows, self.size = [kept], len(kept[0])

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        q, i, d = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        order = np.lexsort((i, d, q))
        q, i, d = q[order], i[order], d[order]
        new = np.concatenate(([True], (q[1:] != q[:-1]) | (i[1:] != i[:-1])))
        q, i, d = q[new], i[new], d[new]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return q[place < self.k], i[place < self.k], d[place < self.k]


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors - query).sum(axis=1))


def _exact(queries, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best = Nearest(k)
    for batch in batches:
        vectors, ids = matrix(batch), batch.column("vec_id").to_numpy()
        for own, q in queries.value:
            d = np.where(ids == own, np.inf, distances(vectors, q))
            best.offer(own, ids, d)
    q, i, d = best.best()
    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(d)], names=["query_id", "vec_id", "score"])


def exact_neighbours(queries: list[tuple[int, np.ndarray]], index: DataFrame, k: int) -> DataFrame:
    """Brute force over all of ``index`` for a bounded list of queries."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    return best_of(index.select("vec_id", "embedding").mapInArrow(
        lambda it: _exact(shared, k, it), "query_id long, vec_id long, score double").filter(
            F.col("score") < float("inf")), k)


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def probes_needed(forest: Forest, queries: list[tuple[int, np.ndarray]], index: DataFrame, k: int) -> int:
    """Leaves to visit so that ``RECALL`` of the true neighbours of ``queries`` are among them."""
    by_id = dict(queries)
    near = exact_neighbours(queries, index, k).select("query_id", "vec_id")
    rows = index.join(F.broadcast(near), "vec_id").select("query_id", "embedding").collect()
    if not rows:
        return len(forest.trees)
    leaves = forest.leaves_of(np.array([r["embedding"] for r in rows], np.float64))
    order = {q: {leaf: i for i, leaf in enumerate(forest.probe(v, 1 << 30))} for q, v in by_id.items()}
    first = sorted(min(order[r["query_id"]][leaf] for leaf in own.tolist()) for r, own in zip(rows, leaves, strict=True))
    return max(len(forest.trees), first[min(len(first) - 1, int(np.ceil(RECALL * len(first))) - 1)] + 1)


def _file(forest, blocks, probes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, block, is_vector, id, embedding): vectors under their leaves, queries under those they visit."""
    for batch in batches:
        vectors, ids = matrix(batch), batch.column("vec_id").to_numpy()
        leaf, row, block = [], [], []
        if batch.column("is_vector")[0].as_py():
            own = forest.value.leaves_of(vectors)
            for t in range(own.shape[1]):
                leaf.append(own[:, t])
                row.append(np.arange(len(ids)))
                block.append((ids * 2654435761 >> 7) % blocks.value[own[:, t]])
        else:
            for i, v in enumerate(vectors):
                visited = np.array(forest.value.probe(v, probes))
                each = blocks.value[visited]
                leaf.append(np.repeat(visited, each))
                row.append(np.full(each.sum(), i))
                block.append(np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
        at = np.concatenate(row)
        for start in range(0, len(at), 4096):
            some = at[start: start + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(leaf)[start: start + 4096]), pa.array(np.concatenate(block)[start: start + 4096]),
                 batch.column("is_vector").take(pa.array(some)), batch.column("vec_id").take(pa.array(some)),
                 batch.column("embedding").take(pa.array(some))],
                names=["leaf", "block", "is_vector", "vec_id", "embedding"])


def _rank(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best, key, queries = Nearest(k), None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        places = batch.column("leaf").to_numpy() << 20 | batch.column("block").to_numpy()
        is_vector, ids, vectors = batch.column("is_vector").to_numpy(zero_copy_only=False), batch.column("vec_id").to_numpy(), matrix(batch)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(places)) + 1, [len(places)]))
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if places[start] != key:
                key, queries = places[start], []
            asks = start + int(np.searchsorted(is_vector[start:end], True))
            queries += zip(ids[start:asks].tolist(), vectors[start:asks], strict=True)
            if asks < end:
                for q, v in queries:
                    best.offer(q, ids[asks:end], distances(vectors[asks:end], v))
    q, i, d = best.best()
    for start in range(0, len(q), 100_000):
        some = slice(start, start + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(q[some]), pa.array(i[some]), pa.array(d[some])],
                                         names=["query_id", "vec_id", "score"])


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10, trees: int = TREES, leaf: int = LEAF,
               sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` nearest other vectors found.

    ``is_query`` is a condition on vec_id. Nearest first, ties to the smaller vec_id; ``score`` is the
    Euclidean distance of the original vectors in double precision.

    Vectors null, empty, zero or with null or non-finite components take no part, nor do those of another length
    than most (ties: the longer); nor rows with a null vec_id. Rows of equal id and vector count as
    one. Of equal vectors only the ``k + 1`` smallest ids are indexed, which loses no result, and
    equal queries are searched once. Fewer candidates than ``k``: all that were found, which is all
    if they fit into a leaf. Empty table: empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", "embedding")
    most = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = checkpointed(rows.filter(F.size("embedding") == most["d"]).dropDuplicates(["vec_id", "embedding"]))
    copy = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    index = checkpointed(rows.withColumn("copy", copy).filter(F.col("copy") <= k + 1).drop("copy"))
    asked = rows.filter(is_query).withColumnRenamed("vec_id", "asked_id")
    queries = asked.groupBy("embedding").agg(F.min("asked_id").alias("vec_id"))
    place = F.xxhash64(F.lit(seed), "vec_id")
    grown_on = np.array([r[0] for r in index.orderBy(place, "vec_id").limit(sample).select("embedding").collect()], np.float64)
    rng = np.random.default_rng(seed)
    forest = Forest([grow(grown_on, leaf, rng) for _ in range(trees)])
    probed = [(r["vec_id"], np.array(r["embedding"], np.float64))
              for r in queries.orderBy(place, "vec_id").limit(PROBED).collect()]
    probes = probes_needed(forest, probed, index, k)
    shared = spark.sparkContext.broadcast(forest)

    def filed(df: DataFrame, kind: bool, blocks) -> DataFrame:
        return df.select("vec_id", "embedding", F.lit(kind).alias("is_vector")).mapInArrow(
            lambda it: _file(shared, blocks, probes, it),
            f"leaf long, block long, is_vector boolean, vec_id long, embedding {index.schema['embedding'].dataType.simpleString()}")

    one = spark.sparkContext.broadcast(np.ones(trees * forest.width, np.int64))
    blocks = np.ones(trees * forest.width, np.int64)
    for r in filed(index, True, one).groupBy("leaf").count().collect():
        blocks[r["leaf"]] = -(-r["count"] // BLOCK)
    shares = spark.sparkContext.broadcast(blocks)
    met = filed(index, True, shares).unionByName(filed(queries, False, shares)).repartition(
        partitions(spark), "leaf", "block").sortWithinPartitions("leaf", "block", "is_vector")
    found = best_of(met.mapInArrow(lambda it: _rank(k + 1, it), "query_id long, vec_id long, score double"), k + 1)
    named = asked.join(queries.withColumnRenamed("vec_id", "query_id"), "embedding").select("asked_id", "query_id")
    every = found.drop("rank").join(named, "query_id").filter(F.col("vec_id") != F.col("asked_id"))
    order = Window.partitionBy("asked_id", "query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("asked_id").alias("query_id"), "rank", "vec_id", "score")
