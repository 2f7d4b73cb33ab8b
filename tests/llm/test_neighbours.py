import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import neighbours
from rillmart.llm.frames import ready


def table(spark, rows):
    ready(spark, 4096)
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")


def brute(rows, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in good:
        if q % 100 == 0:
            near = {}
            for i, w in good:
                if i != q and len(w) == len(v):
                    d = float(np.sqrt(np.square(np.array(w, np.float32).astype(float) - np.array(v, np.float32).astype(float)).sum()))
                    near[i] = min(d, near.get(i, d))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:k])]
    return sorted(out)


def found(spark, rows, **kw):
    out = neighbours.neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, **kw).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def test_small_tables_are_searched_whole(spark):
    made = np.random.default_rng(1)
    rows = [(i, made.normal(size=8).tolist()) for i in range(120)]
    rows += [(200, None), (300, [0.0] * 8), (400, [1.0, None] * 4), (500, [float("nan")] * 8), (600, [float("inf")] * 8),
             (None, [1.0] * 8), (700, []), (7, rows[7][1]), (800, rows[3][1]), (801, rows[3][1])]
    got, want = found(spark, rows), brute(rows, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_equal_vectors_and_few_candidates(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 3000, 10)] + [(1, [1.5, 2.0])]
    got = found(spark, rows)
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows, 10)]
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 1.0)]
    assert found(spark, []) == [] and found(spark, [(0, None)]) == []


def test_recall(spark):
    made = np.random.default_rng(2)
    centres = made.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * made.normal(size=16)).tolist()) for i in range(3000)]
    got = {(g[0], g[2]) for g in found(spark, rows, leaf=64)}
    want = {(w[0], w[2]) for w in brute(rows, 10)}
    assert len(got & want) >= 0.9 * len(want)


def test_queue_yields_every_leaf_once():
    made = np.random.default_rng(4)
    sample = made.normal(size=(500, 6))
    forest = neighbours.Forest([neighbours.grow(sample, 20, made) for _ in range(3)])
    leaves = forest.probe(sample[0], 10 ** 6)
    assert len(leaves) == len(set(leaves)) == sum(t.leaves for t in forest.trees)
    assert set(leaves[:3]) >= {int(forest.leaves_of(sample[:1])[0, 0])} or forest.leaves_of(sample[:1])[0, 0] in leaves[:6]


@pytest.mark.parametrize("block", [7])
def test_blocks_of_a_leaf(spark, monkeypatch, block):
    made = np.random.default_rng(5)
    rows = [(i, made.normal(size=4).tolist()) for i in range(100)]
    monkeypatch.setattr(neighbours, "BLOCK", block)
    assert [g[:3] for g in found(spark, rows)] == [w[:3] for w in brute(rows, 10)]
