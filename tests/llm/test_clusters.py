"""Clusters against plain integers and Python's own arithmetic, the search against the full one, and the edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from folioloom.llm import clusters
from harness import differences

KINDS = "vec_id long, embedding array<double>, extra string"


def vectors(n, seed=3, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [x * spread + rng.gauss(0, 0.5) for x in rng.choice(middles)], "x") for i in range(n)]


def brute(rows, k=16, rounds=3):
    ok = lambda v: v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if ok(v)]
    h = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centers = [v for _, v in sorted(((h(i), v) for i, v in kept if i is not None))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            centers[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept] if centers else []
    total = lambda j=None: sum(d for _, d, c in found if j is None or c == j)
    return sorted(((i, c, d, total(c), total(), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for i, d, c in found), key=str)


def results(spark, rows, kinds=KINDS, **options):
    df = spark.createDataFrame(rows, kinds).repartition(3)
    return sorted(map(tuple, clusters.cluster_vectors(df, **options).collect()), key=str)


def test_against_plain_arithmetic(spark):
    rows = vectors(150)
    assert results(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], vectors(1), vectors(7), [(i, [0.5] * 64, None) for i in range(40)], vectors(30) * 3, vectors(60, spread=1e5)])
def test_few_equal_repeated_and_large(spark, rows):
    assert results(spark, rows) == brute(rows)


def test_odd_rows(spark):
    good = vectors(40)
    odd = [(50, None, None), (51, [], None), (52, [0.1] * 63, None), (53, [0.1] * 65, None), (54, [0.1] * 63 + [None], None), (55, [0.1] * 63 + [math.nan], None), (56, [math.inf] + [0.1] * 63, None), (57, [-math.inf] * 64, None), (None, [0.3] * 64, None), (None, [0.3] * 64, None)]
    assert results(spark, good + odd) == brute(good + odd)


def test_beyond_a_long(spark):
    rows = [(i, [(-1) ** i * 1e300] * 64, "") for i in range(20)]
    out = results(spark, rows)
    assert len(out) == 20 and {r[2] for r in out} == {0}


def test_partial_search_is_the_full_search():
    rng = np.random.default_rng(5)
    for n in (1, 2, 500):
        v = rng.integers(-3, 4, (n, 64))  # many ties
        c = np.concatenate([v[:8], rng.integers(-3, 4, (8, 64)), v[:3]])
        cluster, best = clusters.Search(c, rng.permutation(64)).nearest(v)
        full = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (best == full.min(axis=1)).all() and (cluster == full.argmin(axis=1)).all()


def test_names(spark):
    df = spark.createDataFrame([(1, [0.5] * 64, 4)], "cluster long, embedding array<float>, distance int")
    out = clusters.cluster_vectors(df, key="cluster")
    assert out.columns == ["cluster", "_cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.first()[:3] == (1, 0, 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    assert differences(spark, clusters.op13_clusters, clusters.ORACLE, f"/root/testdata/{sf}") == ""
