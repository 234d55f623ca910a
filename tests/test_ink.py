"""Drawn pictures are read back: axes, touching discs, strokes, stacks and marked values."""

import itertools
import math

import numpy as np
import pytest

from assaylake.operators import ink


def frame(spark, pictures):
    rows = [(k, int(x), int(y)) for k, m in pictures.items() for y, x in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "image string, x long, y long")


def axis(height=100, ticks=(), length=4, minor=(), noise=()):
    m = np.zeros((height + 10, 60), dtype=bool)
    m[5 : 5 + height, 20:22] = True
    for y in ticks:
        m[y : y + 2, 20 - length : 20] = True
    for y in minor:
        m[y, 18:20] = True
    for y, x in noise:
        m[y, x] = True
    return m


def test_axis_ticks(spark):
    drawn = {
        "even": axis(ticks=range(10, 100, 18), minor=(13, 40, 41)), "blank": axis(), "label": axis(noise=[(y, 10) for y in range(10, 90, 3)]), "two": axis(ticks=(10, 60)),
        "uneven": axis(ticks=(10, 20, 55, 90)), "bars": axis(ticks=range(8, 90, 20)) | np.pad(np.ones((50, 20), bool), ((55, 5), (30, 10))),
    }
    got = {}
    for r in ink.axis_ticks(frame(spark, drawn)).orderBy("image", "place").collect():
        got.setdefault(r["image"], []).append((r["axis_x"], r["y"], r["length"]))
    assert got == {"even": [(20, y + 0.5, 4) for y in range(10, 100, 18)], "bars": [(20, y + 0.5, 4) for y in range(8, 90, 20)]}
    level = ink.axis_ticks(frame(spark, {"t": drawn["even"].T[::-1]}).selectExpr("image", "69 - y AS x", "x AS y"))
    assert level.count() == 5 and ink.axis_ticks(frame(spark, {}).limit(0)).count() == 0
    right = frame(spark, {"r": axis(ticks=range(10, 100, 18))[:, ::-1]})
    assert [(r["axis_x"], r["y"]) for r in ink.axis_ticks(right, side=1).orderBy("y").collect()] == [(39, y + 0.5) for y in range(10, 100, 18)]


def test_distance_transform():
    rng = np.random.default_rng(0)
    for _ in range(30):
        m = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < 0.8
        off = [(y, x) for y in range(-1, m.shape[0] + 1) for x in range(-1, m.shape[1] + 1) if not (0 <= y < m.shape[0] and 0 <= x < m.shape[1] and m[y, x])]
        want = [[min((y - a) ** 2 + (x - b) ** 2 for a, b in off) for x in range(m.shape[1])] for y in range(m.shape[0])]
        assert (ink.distance_transform(m) == np.array(want)).all()


def disc(shape, x, y, r):
    yy, xx = np.mgrid[: shape[0], : shape[1]]
    return (xx - x) ** 2 + (yy - y) ** 2 <= r * r


@pytest.mark.parametrize("centres", [[(20, 20, 8)], [(20, 20, 8), (32, 20, 8)], [(20, 20, 8), (29, 27, 6)], [(15, 15, 7), (28, 15, 7), (21, 26, 7)], [(15, 15, 6), (40, 40, 5)], [(10, 20, 5), (18, 20, 5), (26, 20, 5), (34, 20, 5)]])
def test_touching_discs(spark, centres):
    picture = np.any([disc((60, 60), *c) for c in centres], axis=0)
    got = [(r["x"], r["y"]) for r in ink.separated_marks(frame(spark, {"p": picture})).collect()]
    assert len(got) == len(centres)
    for x, y, _ in centres:
        assert min(math.hypot(x - a, y - b) for a, b in got) <= 1.0


def test_best_pieces_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(1, 10))
        x, y = np.arange(n, dtype=float) + 5, np.round(rng.normal(size=n) * 3 + 2 * np.arange(n), 1)
        cost = lambda a, b: float(((y[a:b] - np.polyval(np.polyfit(x[a:b], y[a:b], 1), x[a:b])) ** 2).sum()) if b - a > 2 else 0.0
        every = [[0, *c, n] for k in range(n) for c in itertools.combinations(range(1, n), k)]
        best = min(sum(cost(a, b) + 2.0 for a, b in itertools.pairwise(c)) for c in every)
        got = ink.straight_pieces(x, y, 2.0)
        assert [g[0] for g in got[1:]] == [g[1] + 1 for g in got[:-1]] and got[0][0] == 0 and got[-1][1] == n - 1
        assert abs(sum(cost(a, b + 1) + 2.0 for a, b, *_ in got) - best) < 1e-6


def test_strokes(spark):
    grey = np.full((120, 200), 255)
    grey[60, 10:80] = 20  # level line
    grey[10:110, 150] = 20  # upright line
    for k in range(40):
        grey[20 + k // 2, 20 + k] = 30  # curve
    grey[100, 20:28] = 40  # short
    grey[30:33, 110:113] = 40  # speck
    grey[80, 100:120] = 200  # faint
    grey[61, 20:40] = 200  # light rim of the line
    rows = [("p", int(x), int(y), int(grey[y, x])) for y, x in zip(*np.nonzero(grey < 255))]
    got = {(r["kind"], r["x0"], r["y0"], r["x1"], r["y1"]) for r in ink.stroke_scan(spark.createDataFrame(rows, "image string, x long, y long, grey int")).collect()}
    assert got == {("straight", 10, 60, 79, 60), ("straight", 150, 10, 150, 109), ("curve", 20, 20, 59, 39), ("short", 20, 100, 27, 100), ("faint", 100, 80, 119, 80)}
    bent = [("p", 1, x, 50 - 2 * x if x < 12 else 26 + 3 * (x - 12)) for x in range(30)]
    parts = [(r["piece"], r["x0"], r["x1"], round(r["slope"], 6)) for r in ink.straight_split(spark.createDataFrame(bent, "image string, component long, x long, y long")).orderBy("piece").collect()]
    assert parts == [(1, 0, 11, -2.0), (2, 12, 29, 3.0)]


def test_stacks(spark):
    palette = [("white", 255, 255, 255), ("red", 200, 0, 0), ("blue", 0, 0, 200)]
    colours = {n: c for n, *c in palette}
    bars = [(10, 19, [("red", 12), ("blue", 20)]), (20, 29, [("red", 12), ("blue", 30)]), (40, 49, [("blue", 8), ("red", 5), ("blue", 9)])]
    rows, want = [], []
    for k, (x0, x1, layers) in enumerate(bars):
        bottom = 89
        for layer, (name, h) in enumerate(layers):
            rows += [("h", x, y, *colours[name]) for x in range(x0, x1 + 1) for y in range(bottom - h + 1, bottom + 1)]
            want.append((k + 1, layer + 1, name, x0, x1, bottom - h + 1, bottom))
            bottom -= h
    rows += [("h", x, y, 190, 10, 10) for x in range(12, 18) for y in range(10, 16)] + [("h", 60, 88, 0, 0, 200)] + [("h", x, 5, 250, 250, 250) for x in range(60)]  # a legend, a speck, paper
    got = ink.stacked_columns(spark.createDataFrame(rows, "image string, x long, y long, r int, g int, b int"), palette, "white", baseline=89)
    assert sorted(tuple(r[c] for c in ("bar", "layer", "colour", "x0", "x1", "top", "bottom")) for r in got.collect()) == want


@pytest.mark.parametrize("log", [False, True])
def test_marked_values(spark, log):
    rng = np.random.default_rng(1)
    f = (lambda p: 10 ** (3 - p / 50)) if log else (lambda p: 120 - 0.7 * p)
    ticks = spark.createDataFrame([("a", float(p + d), float(f(p))) for p, d in zip(range(0, 200, 25), rng.uniform(-0.5, 0.5, 8))], "panel string, pixel double, value double")
    true = [float(v) for v in rng.uniform(5, 180, 30)]
    marks = spark.createDataFrame([("a", i, round(p), 0.5) for i, p in enumerate(true)] + [("b", 99, 5, 0.5)], "panel string, id int, y long, half double")
    got = {r["id"]: r for r in ink.marked_values(marks, ink.axis_fits(ticks, ["panel"], "pixel", "value", log), ["panel"], "y", "half", log).collect()}
    for i, p in enumerate(true):
        assert got[i]["low"] <= f(p) <= got[i]["high"] and got[i]["status"] == "CANDIDATE"
    assert got[99]["status"] == "TOO_FEW_TICKS" and got[99]["value"] is None
    bad = spark.createDataFrame([("a", 0.0, 1.0), ("a", 10.0, 2.0), ("a", 20.0, 90.0)], "panel string, pixel double, value double")
    assert {r["status"] for r in ink.marked_values(marks.where("panel = 'a'"), ink.axis_fits(bad, ["panel"], "pixel", "value"), ["panel"], "y", "half").collect()} == {"AXIS_NOT_STRAIGHT"}


def test_exploded_rows_are_not_broadcast(spark):
    plan = ink.axis_ticks(spark.range(2).selectExpr("id AS image", "explode(sequence(1, 40)) AS y").selectExpr("image", "20 AS x", "y"))._jdf.queryExecution().toString()
    assert "Broadcast" not in plan.split("== Physical Plan ==")[1]


def test_cuts_do_not_depend_on_blocks(monkeypatch):
    """Residuals are computed for blocks of columns; the cuts have the least cost of all, whatever the block."""
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 9):
        x, y = np.arange(n, dtype=float), np.round(r.normal(0, 4, n).cumsum())
        found = []
        for cuts in (1, 20, 1 << 16):
            monkeypatch.setattr(ink, "CUTS", cuts)
            found.append(ink.straight_pieces(x, y, 2.0))
        assert found[0] == found[1] == found[2]

        def cost(edges):
            return sum(2 + (np.square(y[a:b] - np.polyval(np.polyfit(x[a:b], y[a:b], 1), x[a:b])).sum() if b - a > 1 else 0) for a, b in itertools.pairwise(edges))

        ways = [(0, *inner, n) for k in range(n) for inner in itertools.combinations(range(1, n), k)]
        assert not n or abs(cost((*[p[0] for p in found[0]], n)) - min(map(cost, ways))) < 1e-6
