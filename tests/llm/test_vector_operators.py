"""Top-k and near-duplicates of vectors against brute force."""

import numpy as np
import pytest

from assaylake.llm import embed_dedup, entries, topk

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], g, 7, "x") for i, e, g in rows], SCHEMA)


def strange(spark):
    nan, inf = float("nan"), float("inf")
    return frame(spark, [(0, [1, 0], 1), (50, [1, 0], 1), (100, None, 1), (150, [], 1), (1, [None, 1], 1), (2, [nan, 1], 1), (3, [inf, 1], 1), (4, [0, 0], 1), (5, [1, 0], None), (None, [1, 0], 1), (6, [1, 0, 0], 1), (7, [1, 0], 2), (8, [1, 0.1], 1), (8, [1, 0.1], 1)])


def best(ids, x, every, k):
    grid = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        score = grid @ grid[q]
        order = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != ids[q])[:k]
        out += [(int(ids[q]), r + 1, i, -s) for r, (s, i) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("block", [64, 8192])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(3)
    ids = np.arange(600)
    x = np.round(rng.normal(size=(600, 6)), 1).astype(np.float32)  # coarse: many ties
    rows = frame(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x)]).repartition(3)
    assert sorted(map(tuple, topk.top_k(rows).collect())) == best(ids, x, 50, 5)
    monkeypatch.setattr(topk, "MAX_QUERY_BYTES", 500)  # several passes
    assert sorted(map(tuple, topk.top_k(rows).collect())) == best(ids, x, 50, 5)


def test_the_walk_stops_early():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(4000, 4)) ** 3 * 100)
    block = topk.Block(np.arange(4000), rows)
    seen = []
    real, topk.merge = topk.merge, lambda best, scores, *a: (seen.append(len(scores)), real(best, scores, *a))[1]
    try:
        got = block.search(rows[7], 7, 5, [])
    finally:
        topk.merge = real
    assert [(s, i) for s, i in got] == sorted((-s, i) for i, s in enumerate((rows @ rows[7]).astype(int).tolist()) if i != 7)[:5] and sum(seen) < 4000


def test_top_k_edges(spark):
    got = sorted(map(tuple, topk.top_k(strange(spark)).collect()))
    assert {r[0] for r in got} == {0, 50} and {r[2] for r in got if r[0] == 0} == {50, 8, 5, 7, 4} and [r[1] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]
    assert topk.top_k(strange(spark).limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_large_components(spark, monkeypatch, limit):
    monkeypatch.setattr(topk, "MAX_QUERY_BYTES", max(limit, 1))
    rows = spark.createDataFrame([(0, [1e30, 2.0]), (1, [1e30, 1.0]), (2, [1e30, 5.0]), (3, [-1e30, 1.0]), (4, [-1e30, 3.0]), (5, [1.7e308, 0.0]), (6, [0.0, 2.0**40]), (7, [0.0, 3.0]), (8, [0.0, 3.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(rows, k=8).orderBy("rank").collect()
    grid = {r["vec_id"]: [int(c) * 256 for c in r["embedding"]] for r in rows.collect()}
    want = sorted((-sum(a * b for a, b in zip(grid[0], v)), i) for i, v in grid.items() if i)
    most = (1 << 63) - 1
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, max(~most, min(most, -s))) for s, i in want]


@pytest.mark.parametrize("n", [60, 300])
def test_large_components_in_a_full_block(spark, n):
    """More candidates at once than are kept: their scores are no longs."""
    rows = spark.createDataFrame([(i, [1e200 * (i % 7 - 3), 1e199 * (i % 11), 1.0]) for i in range(n)], "vec_id long, embedding array<double>").coalesce(1)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in topk.top_k(rows).orderBy("query_id", "rank").collect()]
    grid = {r["vec_id"]: [int(c) * 256 for c in r["embedding"]] for r in rows.collect()}
    want = []
    for q in range(0, n, 50):
        best = sorted((-sum(a * b for a, b in zip(grid[q], v)), i) for i, v in grid.items() if i != q)[:5]
        want += [(q, k + 1, i) for k, (_, i) in enumerate(best)]
    assert got == want


def grouped(ids, x, labels, limit):
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = (u @ u.T >= limit) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    root = ids.copy()
    while True:
        new = np.array([min([root[i], *root[near[i]]]) for i in range(len(ids))])
        if (new == root).all():
            return near.sum(axis=1), root
        root = new


def clusters(seed=2, spread=0.22):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 64))
    x = np.concatenate([b + spread * rng.normal(size=(rng.integers(1, 30), 64)) for b in base] + [rng.normal(size=(300, 64))]).astype(np.float32)
    x = np.concatenate([x, x[:50], x[:20]])  # equal vectors
    return rng.permutation(len(x) * 3)[: len(x)], x, rng.integers(0, 2, len(x))


@pytest.mark.parametrize("tile", [5, 4096])
def test_near_duplicates(spark, monkeypatch, tile):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    ids, x, labels = clusters()
    n_links, root = grouped(ids, x, labels, 0.93)
    rows = frame(spark, [(int(i), v.tolist(), int(g)) for i, v, g in zip(ids, x, labels)]).repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_duplicates(rows).collect()}
    found, there = sum(v[0] for v in got.values()), n_links.sum()
    assert 0.99 * there <= found <= there and all(got[i][0] <= n for i, n in zip(ids.tolist(), n_links.tolist()))
    if found == there:
        assert got == {int(i): (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, n_links, root)}


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.93 meet in some bucket."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = embed_dedup.codes(a, 6, 2), embed_dedup.codes(b, 6, 2)
    met = (x[:, :, 0] == y[:, :, 0]) | (x[:, :, 1:] == y[:, :, :1]).any(axis=2) | (y[:, :, 1:] == x[:, :, :1]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.95


def test_near_duplicate_edges(spark):
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_duplicates(strange(spark)).collect()), key=str)
    want = {0: (3, 0), 50: (3, 0), 8: (3, 0), 100: (0, 100), 150: (0, 150), 1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7)}
    assert len(got) == 14 and all((n, c) == want[i] for i, n, c, _ in got if i is not None) and (None, 0, None, None) in got
    assert embed_dedup.near_duplicates(strange(spark).limit(0)).count() == 0


def test_hadamard():
    x = np.random.default_rng(0).normal(size=(3, 16))
    assert np.allclose(embed_dedup.hadamard(embed_dedup.hadamard(x)), 16 * x) and entries.queries()["op9_embed_dedup"] is entries.op9_embed_dedup
