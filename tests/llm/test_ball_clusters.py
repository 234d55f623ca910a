"""Ball-tree clustering against plain assignment in whole numbers."""

import hashlib

import numpy as np
import pytest

from assaylake.llm import ball_clusters

SCHEMA = "vec_id long, embedding array<double>, cluster int, inertia string"
MOST = (1 << 63) - 1


def plain(rows, k, rounds, scale=64):
    """{id: (cluster, distance, cluster inertia, inertia, hash)} for rows of (id, components), ids unique."""
    grid = {i: [int(c * scale // 1) if abs(c) < 2**53 else int(c) * scale for c in x] for i, x in rows}
    cents = [grid[i] for i in sorted(grid, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:k]]
    for step in range(rounds + 1):
        found = {i: min((sum((a - b) ** 2 for a, b in zip(g, c)), j) for j, c in enumerate(cents)) for i, g in grid.items()}
        for j in range(len(cents)) if step < rounds else ():
            own = [grid[i] for i, (_, c) in found.items() if c == j]
            if own:
                cents[j] = [sum(v) // len(own) for v in zip(*own)]
    sums = {j: sum(d for d, c in found.values() if c == j) for j in range(len(cents))}
    return {i: (j, min(d, MOST), min(sums[j], MOST), min(sum(sums.values()), MOST), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, (d, j) in found.items()}


def got_of(df):
    return {r["vec_id"]: (r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("leaf", [4, 96])
def test_against_plain_assignment(spark, monkeypatch, leaf):
    monkeypatch.setattr(ball_clusters, "LEAF", leaf)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 3)) * 30
    x = np.round(np.concatenate([c + rng.normal(size=(60, 3)) for c in centres]), 1)  # clustered, with ties and repeated vectors
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x) * 2), x)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    assert got_of(ball_clusters.cluster(df, k=9, dims=3)) == plain(rows, 9, 3)


def test_whole_balls_are_assigned():
    rng = np.random.default_rng(0)
    rows = np.floor(np.concatenate([rng.normal(size=(500, 8)) + 100 * j for j in range(4)]) * 64)
    tree = ball_clusters.Tree(rows)
    cents = [[64 * 100 * j] * 8 for j in range(4)]
    parts = list(ball_clusters.Filter(tree, cents).parts())
    whole = [n for n, _, d in parts if d is None]
    assert sum(int(tree.end[n] - tree.start[n]) for n in whole) > 1500 and sum(int(tree.end[n] - tree.start[n]) for n, _, _ in parts) == 2000
    for n in whole:
        assert (tree.sums[n] == tree.rows_of(n).sum(axis=0)).all()
    settled = np.sort(np.concatenate([tree.order[tree.start[n] : tree.end[n]] for n, _, _ in parts]))
    assert (settled == np.arange(2000)).all()


@pytest.mark.parametrize("big", [3e4, 1e30, 1.7e308])
def test_large_components(spark, big):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)] + [(200 + i, [big * (i - 3), 1.0, 0.5, -big / 7]) for i in range(5) if abs(big * (i - 3)) < float("inf")]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    assert got_of(ball_clusters.cluster(df, k=16, dims=4)) == plain(rows, 16, 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [0.0, 0.0]), (None, [5.0, 5.0]), (1, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = ball_clusters.cluster(df, k=16, dims=2)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    ids = sorted((r["vec_id"] or -1, r["distance"]) for r in got.collect())
    assert ids == [(-1, 0), (1, 0), (1, 0), (2, 0), (9, 0)]
    assert len({r["cluster"] for r in got.collect()}) == 3  # three different vectors; equal starts go to the smaller number
    assert ball_clusters.cluster(df.limit(0), dims=2).count() == 0 and ball_clusters.cluster(df, dims=7).count() == 0


def test_digits():
    for n in (0, 5, -5, 1 << 59, -(1 << 60), 12345678901234567890123456789, -(10**60)):
        assert sum(v << (40 * k) for k, v in ball_clusters.digits(n)) == n and all(abs(v) < 1 << 60 for _, v in ball_clusters.digits(n))
