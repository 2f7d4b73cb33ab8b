import hashlib
import math
import random

import numpy as np
import pytest

from rillmart.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, inertia int"


def plain(rows, k=40, rounds=5):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
             if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(whole, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in first[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda v: min((apart(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in whole:
            groups.setdefault(assign(v)[1], []).append(v)
        cents = [[sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(cents)]
    out = [(i, *assign(v)) for i, v in whole]
    inertia = [sum(d for _, d, c in out if c == j) for j in range(len(cents))]
    return sorted((str(i), c, d, inertia[c], sum(inertia), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for i, d, c in out)


def got(frame):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect())


def vectors(n, seed):
    r = random.Random(seed)
    return [(i, [r.gauss(r.choice([-1, 0, 2]), 0.5) for _ in range(64)], "c", 1) for i in range(n)]


@pytest.mark.parametrize("n,k,block", [(130, 40, 8192), (60, 7, 16), (5, 40, 2)])
def test_clusters_equal_a_plain_version(spark, monkeypatch, n, k, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = vectors(n, n)
    rows += [(1000, None, "c", 1), (1001, [1.0] * 63, "c", 1), (1002, [None] + [1.0] * 63, "c", 1), (1003, [float("nan")] * 64, "c", 1),
             (1004, [float("inf")] * 64, "c", 1), (1005, [], "c", 1), (1006, [0.0] * 64, "c", 1), (None, [0.5] * 64, "c", 1)]
    rows += [rows[3]] * 3 + [(2000 + i, rows[2][1], "c", 1) for i in range(n // 2)]
    assert got(centroids.cluster_report(spark.createDataFrame(rows, SCHEMA), k=k)) == plain(rows, k)


def test_search_is_exact_on_ties_and_extremes():
    r = np.random.default_rng(3)
    for _ in range(200):
        k, n, size = r.integers(1, 41), r.integers(1, 120), int(r.choice([1, 2, 64]))
        most = int(r.choice([1, 4, 300, centroids.BOUND]))
        x, c = r.integers(-most, most + 1, (n, size)), r.integers(-most, most + 1, (k, size))
        number, distance = centroids.nearest(x, c)
        full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_search_looks_at_few_centroids():
    """The inequalities spare most distances where vectors differ in level."""
    r = np.random.default_rng(4)
    x = (r.normal(0, 20, (4000, 64)) + r.integers(-20, 20, (4000, 1)) * 40).astype(np.int64)
    looked = []
    einsum = np.einsum
    try:
        np.einsum = lambda how, a, b: (looked.append(len(a)), einsum(how, a, b))[1]
        centroids.nearest(x, x[:40])
    finally:
        np.einsum = einsum
    assert sum(looked) < 0.25 * 4000 * 40


def test_huge_components_and_empty_table(spark):
    big = [(1, [3e38] * 64, "c", 1), (2, [-3e38] * 64, "c", 1), (3, [0.0] * 64, "c", 1)]
    rows = centroids.cluster_report(spark.createDataFrame(big, SCHEMA), k=2).collect()
    assert len(rows) == 3 and all(r.distance >= 0 for r in rows)
    assert centroids.cluster_report(spark.createDataFrame([], SCHEMA)).count() == 0
