"""Hard negatives against all pairs in whole numbers."""

import numpy as np
import pytest

from assaylake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string"
MOST = (1 << 63) - 1


def plain(rows, every=100, k=5):
    """Rows of the result for (id, components, label) with ids unique; scores as exact numbers."""
    grid = {i: [int(c * 256 // 1) if abs(c) < 2**53 else int(c) * 256 for c in x] for i, x, _ in rows}
    label = {i: g for i, _, g in rows}
    out = []
    for a in (i for i in grid if i % every == 0):
        score = {i: sum(p * q for p, q in zip(grid[a], grid[i])) for i in grid if i != a and len(grid[i]) == len(grid[a])}
        first = lambda ids: sorted(ids, key=lambda i: (-score[i], i))[:k]
        for p in first([i for i in score if label[i] == label[a]]):
            found = first([i for i in score if label[i] != label[a] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]])
            out += [(a, p, r + 1, i, max(~MOST, min(MOST, score[p])), max(~MOST, min(MOST, score[i]))) for r, i in enumerate(found)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, g, "x") for i, x, g in rows], SCHEMA)


def skewed(n=900, d=16, seed=1):
    """Vectors with a few strong directions, coarse so that scores tie."""
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    x = np.round((rng.normal(size=(n, d)) * np.geomspace(2, 0.02, d)) @ turn, 2)
    return [(int(i), v.tolist(), int(g)) for i, v, g in zip(rng.permutation(n * 2)[:n], x, rng.integers(0, 3, n))]


@pytest.mark.parametrize("block,anchors,size", [(4096, 1024, 64 << 20), (64, 3, 64 << 20), (100, 1024, 1000)])
def test_against_all_pairs(spark, monkeypatch, block, anchors, size):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "MAX_ANCHOR_BYTES", size)
    rows = skewed()
    got = hard_negatives.mine(frame(spark, rows).repartition(3))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(rows) != []


def test_pairs_are_discarded_early():
    rows = skewed(3000)
    ids, x, labels = (np.array(c) for c in zip(*rows))
    grid = np.floor(x * 256)
    turn = np.linalg.eigh(grid.T @ grid)[1][:, ::-1]
    asked, block = hard_negatives.Side(ids[:50], labels[:50], grid[:50], turn), hard_negatives.Side(ids[50:], labels[50:], grid[50:], turn)
    score = grid[:50] @ grid[50:].T
    low = np.sort(np.where(labels[:50, None] == labels[None, 50:], score, -np.inf), axis=1)[:, -5]
    a, b = hard_negatives.survivors(asked, block, low.astype(np.int64), np.full(50, MOST), True)
    there = np.argwhere((labels[:50, None] == labels[None, 50:]) & (score >= low[:, None]))
    assert set(map(tuple, there.tolist())) <= set(zip(a.tolist(), b.tolist())) and len(a) < 0.05 * score.size
    assert (hard_negatives.products(asked, block, a, b) == score[a, b]).all()


@pytest.mark.parametrize("big", [3e7, 1e30, 1e308])
def test_large_components(spark, big):
    rows = [(i, [big / 10 * (i % 9 - 3), (i % 5) * (big / 1000), 1.0 + i % 3], i % 2) for i in range(120)]
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows), anchor_every=30).collect())) == plain(rows, 30) != []


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2), (3, [0.9, 0.0], 3), (3, [0.9, 0.0], 3), (4, None, 2), (5, [], 2), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (None, [1.0, 0.0], 2), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 2), (11, [-1.0, 0.0], 1), (100, [0.0, 0.0], 4), (200, [5.0], 7)]
    got = sorted(map(tuple, hard_negatives.mine(frame(spark, rows)).collect()))
    assert got == [(0, 1, 1, 2, 65536, 58880), (0, 1, 2, 3, 65536, 58880)]  # the negative product of 11 leaves no room; 100 has no positive
    doubled = rows + [(0, [0.5, 0.5], 2)]  # the row with the smaller label is the anchor
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, doubled)).collect())) == got
    assert hard_negatives.mine(frame(spark, rows).limit(0)).count() == 0


def test_zero_scores_meet_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 2), (3, [0.0, -1.0], 2), (4, [-1.0, 0.0], 2)]
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows)).collect())) == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)]
