"""Clustering against plain rounds in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from tillmetrics.llm import centroids
from tillmetrics.llm.centroids import approach, cluster, report


def plain(rows, k, rounds, dims, scale=1024, seed=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    def rank(r):
        if r[0] is None:
            return ("~", r[1])
        return (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])

    centres = [list(r[1]) for r in sorted(kept, key=rank)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for j in range(len(centres)):
            own = [v for (c, _), (_, v) in zip(of, kept) if c == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own)]
    of = assign()
    inertia = [sum(d for c, d in of if c == j) for j in range(len(centres))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, inertia[c], sum(inertia), shas[c]) for (i, _), (c, d) in zip(kept, of)]


def table(spark, rows):
    schema = "vec_id long, embedding array<double>, label int, pos long, cluster string, comps string"
    return spark.createDataFrame([(i, v, 1, 5, "x", "y") for i, v in rows], schema).repartition(3)


def check(spark, rows, k, rounds, dims):
    got = report(cluster(table(spark, rows), k=k, rounds=rounds, dims=dims)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows, k, rounds, dims)))


def test_matches_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BUCKET_ROWS", (60, 1_000_000))
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.2]) for i in range(400)]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None), (1001, []), (1002, [1.0] * 7), (1003, [nan] + [0.0] * 7), (1004, [-inf] * 8)]
    rows += [(1005, [None] + [0.5] * 7), (1006, [-0.0] * 8), (1007, [1e-9] * 8), (1008, [-1e-9] * 8)]
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[3][1]), (2000, rows[4][1])]
    check(spark, rows, 8, 10, 8)


def test_ties_few_rows_and_empty_clusters(spark):
    square = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(0, 0), (0, 2), (2, 0), (2, 2), (1, 1)] * 5)]
    check(spark, square, 4, 6, 2)
    check(spark, [(i, [1.0, 1.0]) for i in range(10)], 4, 3, 2)
    check(spark, square[:3], 8, 10, 2)
    check(spark, square[:1], 8, 10, 2)
    assert report(cluster(table(spark, []), k=8, dims=2)).collect() == []
    assert report(cluster(table(spark, [(1, None)]), k=8, dims=2)).collect() == []


def test_too_large_components_end_the_query(spark):
    with pytest.raises(Exception, match="beyond 2"):
        cluster(table(spark, [(1, [1e300, 0.0])]), dims=2)


def test_approach_bounds_every_point_of_the_sphere():
    rng = np.random.default_rng(8)
    gained = 0
    for _ in range(60):
        k, dims = 5, int(rng.integers(2, 6))
        old = rng.normal(size=(k, dims)) * 10
        new = old + rng.normal(size=(k, dims)) * rng.choice([0, 0.1, 3])
        radius = rng.uniform(0, 6, k)
        bound = approach(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        assert (bound <= drift[None, :] * (1 + 1e-8)).all() and (bound >= 0).all()
        gained += (bound < drift[None, :] * 0.9).sum()
        for i in range(k):
            way = rng.normal(size=(400, dims))
            x = old[i] + radius[i] * way / np.sqrt((way**2).sum(1))[:, None]
            nearer = np.sqrt(((x[:, None] - old) ** 2).sum(2)) - np.sqrt(((x[:, None] - new) ** 2).sum(2))
            assert (nearer.max(0) <= bound[i] + 1e-9).all()
    assert gained > 100


def test_bounds_spare_most_scans(spark, monkeypatch):
    """With clusters far apart only the first round and few rows later are scanned."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 16)) * 5
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=16) * 0.3]) for i in range(800)]
    scanned = []
    scan = centroids._scan

    def counting(state, base, at, first):
        scanned.append(state.count())
        return scan(state, base, at, first)

    monkeypatch.setattr(centroids, "_scan", counting)
    check(spark, rows, 8, 10, 16)
    assert scanned[0] == 800 and sum(scanned[1:]) < 800 * (len(scanned) - 1)
