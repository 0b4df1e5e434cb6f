"""Operators on vectors against plain Python: centroid clustering and hard negatives."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesmith.llm import centroid_clustering as cc
from lakesmith.llm import hard_negatives as hn
from lakesmith.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, id long, row long, x string, block long, cluster string, anchor long"


def table(spark, rows):
    """Rows ``(vec_id, vector, label)`` with further columns named like the operators' own."""
    return spark.createDataFrame([(i, v, y, 1, 2, "x", 3, "c", 4) for i, v, y in rows], SCHEMA)


def ints(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def finite(v, dims=None):
    return v is not None and (dims is None or len(v) == dims) and all(x is not None and math.isfinite(x) for x in v)


def plain_clusters(rows, dims, k, rounds, salt="2"):
    kept = [(i, ints(v)) for i, v, _ in rows if finite(v, dims)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min((dist(v, c), n) for n, c in enumerate(centroids))[::-1]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, _, d in found)
    inertia = {n: sum(d for _, m, d in found if m == n) for _, n, _ in found}
    return sorted(((i, n, d, inertia[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, n, d in found), key=repr)


def plain_negatives(rows, anchor, share=(80, 100), most=5):
    taken = [(i, ints(v), y) for i, v, y in rows if y is not None and finite(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (i, v, y) in enumerate(taken):
        if i is None or not anchor(i):
            continue
        scored = sorted(((-dot(v, w), last(j), j, z) for m, (j, w, z) in enumerate(taken) if m != n))
        for p, _, j, _ in [s for s in scored if s[3] == y][:most]:
            near = [(-s, k) for s, _, k, z in scored if z != y and share[0] * -p <= share[1] * -s <= share[1] * -p]
            out += [(i, j, r + 1, k, -p, s) for r, (s, k) in enumerate(near[:most])]
    return sorted(out, key=repr)


def odd_rows(seed=1, n=220, dims=16):
    """Clusters of different spread, ties, repeated rows and ids, copies, and rows that are not vectors."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (6, dims))
    rows = [(i, [float(x) for x in centers[i % 6] + rng.normal(0, 0.05 * (1 + i % 4), dims)], i % 3) for i in range(n)]
    rows += [(500 + i, rows[3][1], i % 3) for i in range(40)]   # one vector, many ids
    rows += [rows[7], rows[7], rows[0], (None, rows[9][1], 1), (None, rows[9][1], None), (3, None, 1), (4, [], 2), (5, [1.0], 0)]
    rows += [(6, [float("nan")] + [0.0] * (dims - 1), 1), (8, [float("inf")] * dims, 1), (9, [None] * dims, 1), (10, [0.0] * dims, 0), (11, [1e30] * dims, 0)]
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("clusters", "rounds"), [(12, 5), (1, 2), (400, 2), (7, 0)])
def test_clusters_against_plain_python(spark, clusters, rounds):
    rows = [r for r in odd_rows() if r[0] != 11]
    got = cc.centroid_clustering(table(spark, rows), dims=16, clusters=clusters, rounds=rounds)
    assert result(got) == plain_clusters(rows, 16, clusters, rounds)


def test_clusters_bounds_spare_scans(spark):
    """On separated clusters most vectors keep their cluster without a full scan; the result is the plain one."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(4 * (i % 8), 0.3, 16)], 0) for i in range(600)]
    tally = []
    got = cc.centroid_clustering(table(spark, rows), dims=16, clusters=8, rounds=5, tally=tally)
    assert result(got) == plain_clusters(rows, 16, 8, 5)
    assert tally[0] == 600 and min(tally) < 300


def test_clusters_empty(spark):
    for rows in ([], [(1, None, 0), (2, [1.0], 0)]):
        df = cc.centroid_clustering(table(spark, rows), dims=16)
        assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and df.count() == 0


def test_distances_are_exact():
    rng = np.random.default_rng(2)
    for most in (300, 1 << 20, 1 << 26):
        x, c = rng.integers(-most, most, (50, 64)), rng.integers(-most, most, (7, 64))
        assert cc.squared_distances(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in c] for p in x]


def test_loosening_bounds_every_point():
    """No point of a sphere comes nearer to a moved centroid than the bound says; the bound is below the full drift."""
    rng = np.random.default_rng(3)
    less = 0
    for trial in range(300):
        dims, k = int(rng.integers(2, 6)), 3
        old = rng.normal(0, 10, (k, dims))
        new = old + rng.normal(0, rng.choice([0.1, 2.0, 20.0]), (k, dims))
        if trial % 5 == 0:
            new[1] = old[1]
        radius = np.abs(rng.normal(0, rng.choice([0.5, 5.0, 15.0]), k))
        found = cc.loosening(old, new, radius)
        for i in range(k):
            way = rng.normal(0, 1, (400, dims))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (400, 1)) ** (1 / dims)
            nearer = [np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1) for j in range(k) if j != i]
            drift = max(np.linalg.norm(new[j] - old[j]) for j in range(k) if j != i)
            assert np.max(nearer) <= found[i] + 1e-9
            assert found[i] <= drift * (1 + 1e-5) + 1e-12
            less += found[i] < 0.9 * drift
    assert less > 300


def test_scores_are_exact():
    rng = np.random.default_rng(4)
    for most, dims in ((1, 3), (300, 64), (1 << 27, 5), (1 << 20, 65)):
        x, a = rng.integers(-most, most + 1, (70, dims)), rng.integers(-most, most + 1, (9, dims))
        x[0], x[1], a[0] = -most, most, -most
        assert (hn.scores(hn.bit_planes(x), hn.subset_sums(a)) == x @ a.T).all()
    assert hn.scores(hn.bit_planes(np.zeros((3, 8), int)), hn.subset_sums(np.ones((2, 8), int))).tolist() == [[0, 0]] * 3


@pytest.mark.parametrize(("held", "block"), [(hn.HELD, hn.ANCHORS), (17, 3)])
def test_negatives_against_plain_python(spark, held, block):
    rows = [r for r in odd_rows(n=150) if r[0] != 11]
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 7 == 0, held=held, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert result(got) == plain_negatives(rows, lambda i: i % 7 == 0) != []


def test_negatives_ties_and_empty(spark):
    same = [(i, [0.5] * 16, i % 2) for i in range(100, 160)]   # equal scores: ids decide
    assert result(hn.hard_negatives(table(spark, same), F.col("vec_id") % 50 == 0)) == plain_negatives(same, lambda i: i % 50 == 0) != []
    for rows in ([], [(1, [1.0] * 16, 0)], [(100, None, 1)], [(100, [1.0] * 16, None)], [(100, [-1.0] * 16, 1), (200, [1.0] * 16, 1)]):
        assert hn.hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


def test_query_relabels(spark, tmp_path):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(0.3, 0.2, 16)], None if i % 50 == 9 else i % 10) for i in range(0, 310)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, y if y is None or i % 7 else (y + 1) % 10) for i, v, y in rows]
    assert result(queries.op12_hard_negatives(spark, str(tmp_path))) == plain_negatives(moved, lambda i: i % 100 == 0)
