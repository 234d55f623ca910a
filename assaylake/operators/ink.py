"""Ticks, strokes, touching marks, stacked columns and marked values of pictures given as pixel tables.

ink: image, x, y of dark pixels, y growing downwards. Rules about rows and columns of pixels are windows and aggregates over the
pixel table, keyed by image and row or column; what needs a component as a whole (distance transforms, best cuts of a
line) gets one component at a time.

Defined cases: repeated pixels count once; rows with a null place are left out; an image without ink, or without a finding, has no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.operators.pixels import components, nearest_colour
from assaylake.plans.storage import unsent

NEXT = ((1, 0), (-1, 0), (0, 1), (0, -1))
#: Pieces of a line whose residuals are computed at once.
CUTS = 1 << 16


def ink_runs(ink: DataFrame, along: str, *keys: str) -> DataFrame:
    """(keys, start, end): maximal runs of pixels along one direction."""
    own = ink.select(*keys, along).dropna().distinct()
    island = F.col(along) - F.row_number().over(Window.partitionBy(*keys).orderBy(along))
    return own.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(along).alias("start"), F.max(along).alias("end")).drop("_i")


def islands(rows: DataFrame, at: str, group: list[str], *breaks: Column) -> DataFrame:
    """`rows` with island: it rises where `at` skips a step or one of `breaks` (conditions on the row before) holds."""
    order = Window.partitionBy(*group).orderBy(at)
    opens = F.coalesce(F.col(at) - F.lag(at).over(order) > 1, F.lit(False))
    for b in breaks:
        opens = opens | F.coalesce(b, F.lit(False))
    marked = rows.withColumn("_o", opens.cast("int"))
    return marked.withColumn("island", F.sum("_o").over(order) + 1).drop("_o")


# Axes.


def axis_lines(ink: DataFrame, share: float = 0.5) -> DataFrame:
    """(image, x0, x1, y0, y1): upright lines, as thick as they are, over at least a share of the image's inked height."""
    height = ink.groupBy("image").agg((F.max("y") - F.min("y") + 1).alias("_h"))
    tall = ink_runs(ink, "y", "image", "x").join(unsent(height), "image").where(F.col("end") - F.col("start") + 1 >= share * F.col("_h"))
    column = tall.groupBy("image", "x").agg(F.max_by(F.struct("start", "end"), F.struct(F.col("end") - F.col("start"), -F.col("start"))).alias("r"))
    return islands(column, "x", ["image"]).groupBy("image", "island").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("r.start").alias("y0"), F.max("r.end").alias("y1")).drop("island")


def axis_ticks(ink: DataFrame, share: float = 0.5, reach: int = 12, least: int = 3, tolerance: float = 1.0, side: int = -1, even: bool = True) -> DataFrame:
    """(image, axis_x, place, y, length): the ticks of the upright axis of each image, from the top; for a level axis swap x and y.

    A stub is ink that goes on from the axis to one side (-1: left) without a break, two pixels or more; stubs of neighbouring rows are one tick, at their mean. From
    the profile of stub lengths each length is tried as the shortest that counts: the largest set with steps equal within twice the tolerance wins (ties:
    longer stubs). Fewer than `least` even ticks are none. Of several lines the one with most ticks is the axis, then the leftmost.
    """
    edge = F.col("x0") if side < 0 else F.col("x1")
    lines = axis_lines(ink, share).withColumn("axis_x", edge)
    near = ink.select("image", "x", "y").dropna().distinct().join(unsent(lines), "image").withColumn("_d", (F.col("x") - edge) * side)
    beside = near.where(F.col("_d").between(1, reach) & F.col("y").between(F.col("y0"), F.col("y1")))
    joined = beside.withColumn("_n", F.row_number().over(Window.partitionBy("image", "axis_x", "y").orderBy("_d"))).where("_n = _d")
    stubs = joined.groupBy("image", "axis_x", "y").agg(F.count(F.lit(1)).alias("length")).where("length >= 2")
    keys = ["image", "axis_x"]
    ticks = islands(stubs, "y", keys).groupBy(*keys, "island").agg(F.avg("y").alias("y"), F.max("length").alias("length")).drop("island")
    levels = ticks.select(*keys, F.col("length").alias("level")).distinct()  # `reach` of them at most
    order = Window.partitionBy(*keys, "level").orderBy("y")
    tried = ticks.join(unsent(levels), keys).where("length >= level").withColumn("_step", F.col("y") - F.lag("y").over(order))
    sets = tried.groupBy(*keys, "level").agg(F.count(F.lit(1)).alias("n"), (F.max("_step") - F.min("_step")).alias("_uneven")).where(F.col("n") >= least)
    fit = sets.where(F.col("_uneven") <= 2 * tolerance) if even else sets
    best = fit.groupBy("image").agg(F.max_by(F.struct("axis_x", "level"), F.struct("n", -F.col("axis_x") * -side, "level")).alias("b")).select("image", "b.*")
    return tried.join(unsent(best), ["image", "axis_x", "level"]).select("image", "axis_x", F.row_number().over(Window.partitionBy("image").orderBy("y")).alias("place"), "y", "length")


def axis_fits(ticks: DataFrame, group: list[str], pixel: str, value: str, log: bool = False) -> DataFrame:
    """(group, n, slope, intercept, residual_px): least squares of tick values (their logarithms) on pixels; the residual is the farthest tick in pixels."""
    v = F.log10(value) if log else F.col(value)
    rows = ticks.select(*group, F.col(pixel).alias("_p"), v.alias("_v")).dropna()
    fit = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.regr_slope("_v", "_p").alias("slope"), F.regr_intercept("_v", "_p").alias("intercept"))
    off = F.abs(F.col("_v") - F.col("intercept") - F.col("slope") * F.col("_p")) / F.abs("slope")
    return rows.join(fit, group).groupBy(*group, "n", "slope", "intercept").agg(F.max(off).alias("residual_px"))


def marked_values(marks: DataFrame, fits: DataFrame, group: list[str], pixel: str, half: str, log: bool = False, most_px: float = 2.0) -> DataFrame:
    """`marks` with value, low, high, status: a mark's centre read on its axis, with what half its core and the axis's residual may shift it.

    The interval is taken in pixels and carried through the axis, so on a logarithmic axis it is not even about the value.
    """
    met = marks.join(fits.select(*group, F.col("n").alias("_n"), F.col("slope").alias("_b"), F.col("intercept").alias("_a"), F.col("residual_px").alias("_r")), group, "left")
    shift = F.abs("_b") * (F.col(half) + F.col("_r"))
    at = F.col("_a") + F.col("_b") * F.col(pixel)
    back = (lambda t: F.pow(F.lit(10.0), t)) if log else (lambda t: t)
    status = F.when(F.coalesce(F.col("_n"), F.lit(0)) < 3, "TOO_FEW_TICKS").when(F.coalesce(F.col("_r") > most_px, F.lit(True)), "AXIS_NOT_STRAIGHT").otherwise("CANDIDATE")
    told = met.withColumn("status", status)
    cells = {"value": back(at), "low": back(at - shift), "high": back(at + shift)}
    return told.withColumns({k: F.when(F.col("status") == "CANDIDATE", v) for k, v in cells.items()}).drop("_n", "_a", "_b", "_r")


# Touching marks.


def distance_transform(mask: np.ndarray) -> np.ndarray:
    """Squared distance of each set cell to the nearest unset one; all beyond the edge is unset."""
    inside = np.pad(mask, 1)
    up = np.zeros(inside.shape, dtype=np.int64)
    for y in range(1, inside.shape[0]):
        up[y] = np.where(inside[y], up[y - 1] + 1, 0)
    for y in range(inside.shape[0] - 2, -1, -1):
        up[y] = np.minimum(up[y], np.where(inside[y], up[y + 1] + 1, 0))
    best = up**2
    for d in range(1, int(up.max(initial=0)) + 1):  # a column farther away than the tallest run changes nothing
        best[:, d:] = np.minimum(best[:, d:], up[:, :-d] ** 2 + d * d)
        best[:, :-d] = np.minimum(best[:, :-d], up[:, d:] ** 2 + d * d)
    return best[1:-1, 1:-1]


def mark_centres(mask: np.ndarray, neck: float = 0.75) -> list[tuple[float, float, float]]:
    """(x, y, radius) of the marks that make a piece of ink: peaks of its distance transform with a narrower neck between any two.

    Discs that fill the middle between them, so that it is the widest place, cannot be told apart this way. Peaks are taken from the widest down; one is a mark of its own if on the straight way to every mark before it the ink gets narrower than both by `neck`.
    """
    d = np.sqrt(distance_transform(mask))
    wide = np.pad(d, 1)
    around = np.max([wide[1 + dy : 1 + dy + d.shape[0], 1 + dx : 1 + dx + d.shape[1]] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
    ys, xs = np.nonzero((d > 0) & (d >= around))
    marks: list[tuple[float, float, float]] = []
    for k in np.lexsort((xs, ys, -d[ys, xs])).tolist():
        x, y, r = float(xs[k]), float(ys[k]), float(d[ys[k], xs[k]])

        def apart(x: float, y: float, r: float, mark: tuple[float, float, float]) -> bool:
            steps = max(2, int(2 * max(abs(mark[0] - x), abs(mark[1] - y))) + 1)
            way = d[np.round(np.linspace(y, mark[1], steps)).astype(int), np.round(np.linspace(x, mark[0], steps)).astype(int)]
            return bool(way.min() <= min(r, mark[2]) - neck)

        if all(apart(x, y, r, m) for m in marks):
            level = (np.abs(d[ys, xs] - r) < 1e-9) & (np.hypot(xs - x, ys - y) <= max(1.5, r / 2))  # a flat peak is one place
            marks.append((float(xs[level].mean()), float(ys[level].mean()), r))
    return marks


def separated_marks(ink: DataFrame, neck: float = 0.75) -> DataFrame:
    """(image, component, mark, x, y, radius): the marks of each connected piece of ink, from the widest; touching and overlapping ones are told apart."""
    parts = components(ink.select("image", "x", "y").dropna())

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x0, y0 = int(pdf["x"].min()), int(pdf["y"].min())
        mask = np.zeros((int(pdf["y"].max()) - y0 + 1, int(pdf["x"].max()) - x0 + 1), dtype=bool)
        mask[pdf["y"].to_numpy(dtype=np.int64) - y0, pdf["x"].to_numpy(dtype=np.int64) - x0] = True
        found = mark_centres(mask, neck)
        return pd.DataFrame([(*key, k + 1, x + x0, y + y0, r) for k, (x, y, r) in enumerate(found)], columns=["image", "component", "mark", "x", "y", "radius"])

    kind = parts.schema["image"].dataType.simpleString()
    return parts.groupBy("image", "component").applyInPandas(run, f"image {kind}, component long, mark long, x double, y double, radius double")


# Strokes.


def elongated(ink: DataFrame, group: list[str], ratio: float = 4.0, least: int = 3) -> DataFrame:
    """(group, x0, y0, x1, y1, n, slender) of pieces of ink: slender if the variance along their main axis is `ratio` times that across it (a tenth at least)."""
    vx, vy, c = (F.coalesce(v, F.lit(0.0)) for v in (F.var_samp("x"), F.var_samp("y"), F.covar_samp("x", "y")))
    got = ink.groupBy(*group).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n"), vx.alias("_vx"), vy.alias("_vy"), c.alias("_c"))
    spread = F.sqrt(F.pow(F.col("_vx") - F.col("_vy"), 2) + 4 * F.pow(F.col("_c"), 2))
    main, across = (F.col("_vx") + F.col("_vy") + spread) / 2, (F.col("_vx") + F.col("_vy") - spread) / 2
    return got.withColumn("slender", (F.col("n") >= least) & (main >= ratio * F.greatest(across, F.lit(0.1)))).drop("_vx", "_vy", "_c")


def stroke_scan(pixels: DataFrame, dark: int = 180, faint: int = 220, straight: int = 40, wide: int = 18, tall: int = 3) -> DataFrame:
    """(image, kind, component, x0, y0, x1, y1, n) of strokes in pixels (image, x, y, grey).

    Dark ink in a run of `straight` pixels along or down is taken out first and comes back as `straight`. Of what is left, pieces of the width and height are `curve`,
    smaller slender ones `short`. Lighter ink that touches no dark pixel makes `faint` pieces if slender. Specks are left out.
    """
    ink = pixels.select("image", "x", "y", "grey").dropna().groupBy("image", "x", "y").agg(F.min("grey").alias("grey"))
    strong = ink.where(F.col("grey") < dark).select("image", "x", "y")
    long_ = F.col("end") - F.col("start") + 1 >= straight
    level = ink_runs(strong, "x", "image", "y").where(long_).select("image", "y", F.explode(F.sequence("start", "end")).alias("x"))
    upright = ink_runs(strong, "y", "image", "x").where(long_).select("image", "x", F.explode(F.sequence("start", "end")).alias("y"))
    lines = level.select("image", "x", "y").unionByName(upright.select("image", "x", "y")).distinct()
    rest = strong.join(lines, ["image", "x", "y"], "left_anti")
    touched = strong.select("image", F.explode(F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in (*NEXT, (0, 0))])).alias("p")).select("image", "p.*").distinct()
    light = ink.where(F.col("grey").between(dark, faint - 1)).select("image", "x", "y").join(touched, ["image", "x", "y"], "left_anti")
    pieces = lambda rows: elongated(components(rows), ["image", "component"])
    big = (F.col("x1") - F.col("x0") + 1 >= wide) & (F.col("y1") - F.col("y0") + 1 >= tall)
    found = pieces(rest).withColumn("kind", F.when(big, "curve").when(F.col("slender"), "short"))
    found = found.unionByName(pieces(light).withColumn("kind", F.when(F.col("slender"), "faint"))).unionByName(pieces(lines).withColumn("kind", F.lit("straight")))
    return found.where("kind IS NOT NULL").select("image", "kind", "component", "x0", "y0", "x1", "y1", "n")


def straight_pieces(x: np.ndarray, y: np.ndarray, penalty: float) -> list[tuple[int, int, float, float]]:
    """(start, end, slope, intercept) of the pieces of a line with the least squared residuals plus `penalty` a piece; ties go to fewer points in earlier pieces."""
    n = len(x)
    x0, y0 = (x[0], y[0]) if n else (0.0, 0.0)
    u, v = x - x0, y - y0
    s = [np.concatenate(([0.0], np.cumsum(c))) for c in (u, v, u * u, u * v, v * v)]
    best, back = np.zeros(n + 1), np.zeros(n + 1, dtype=np.int64)
    step = max(1, CUTS // max(n, 1))
    for a in range(1, n + 1, step):  # the residuals of all pieces that end in a block of columns at once
        ends = np.arange(a, min(a + step, n + 1))
        m = np.maximum(ends[:, None] - np.arange(ends[-1]), 1)
        su, sv, suu, suv, svv = (c[ends][:, None] - c[: ends[-1]] for c in s)
        du, cross = suu - su * su / m, suv - su * sv / m
        left = np.maximum(svv - sv * sv / m - np.divide(cross * cross, du, out=np.zeros(du.shape), where=du > 1e-9), 0)
        for j, row in zip(ends.tolist(), left, strict=True):
            total = best[:j] + row[:j] + penalty
            back[j] = int(np.round(total, 9).argmin())
            best[j] = total[back[j]]
    out, j = [], n
    while j:
        i = int(back[j])
        slope, intercept = np.polyfit(x[i:j], y[i:j], 1) if j - i > 1 else (0.0, y[i])
        out.append((i, j - 1, float(slope), float(intercept)))
        j = i
    return out[::-1]


def straight_split(ink: DataFrame, penalty: float = 2.0) -> DataFrame:
    """(image, component, piece, x0, x1, slope, intercept): pieces of ink cut into straight parts, by the middle of their ink in each column."""
    centre = ink.groupBy("image", "component", "x").agg(F.percentile("y", 0.5).alias("y"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        x, y = pdf["x"].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float)
        rows = [(*key, k + 1, int(x[a]), int(x[b]), s, i) for k, (a, b, s, i) in enumerate(straight_pieces(x, y, penalty))]
        return pd.DataFrame(rows, columns=["image", "component", "piece", "x0", "x1", "slope", "intercept"])

    kind = ink.schema["image"].dataType.simpleString()
    return centre.groupBy("image", "component").applyInPandas(run, f"image {kind}, component long, piece int, x0 long, x1 long, slope double, intercept double")


# Columns on a baseline.


def stacked_columns(pixels: DataFrame, palette: list[tuple[str, int, int, int]], background: str, baseline: int, gap: int = 1, least: int = 2, tolerance: int = 1) -> DataFrame:
    """(image, bar, layer, colour, x0, x1, top, bottom): stacked bars of a histogram in pixels (image, x, y, r, g, b), from the left and from below.

    Every pixel takes the nearest colour of the palette (`background` is none). In each column of pixels the runs of a colour hold on to the baseline, or to the run below with
    `gap` pixels between them at most; what stands higher is no part of the bar. Neighbouring columns with the same colours and tops within `tolerance` are one bar.
    """
    own = nearest_colour(pixels.dropna(subset=["image", "x", "y"]), palette).where(F.col("colour") != background)
    runs = ink_runs(own, "y", "image", "x", "colour").where(F.col("end") - F.col("start") + 1 >= least)
    up = Window.partitionBy("image", "x").orderBy(F.desc("end"), "start")
    under = F.coalesce(F.lag("start").over(up) - 1, F.lit(baseline))
    held = runs.withColumn("_ok", (F.abs(under - F.col("end")) <= gap).cast("int")).withColumn("_held", F.min("_ok").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    column = held.where("_held = 1").groupBy("image", "x").agg(F.array_sort(F.collect_list(F.struct((-F.col("end")).alias("rise"), "colour", "start", "end"))).alias("runs"))
    across = Window.partitionBy("image").orderBy("x")
    before = F.lag("runs").over(across)
    names = lambda r: F.transform(r, lambda e: e["colour"])
    differ = (names(before) != names(F.col("runs"))) | F.exists(F.zip_with(before, F.col("runs"), lambda a, b: F.abs(a["start"] - b["start"]) > tolerance), lambda e: F.coalesce(e, F.lit(True)))
    bars = islands(column, "x", ["image"], differ).select("image", F.col("island").alias("bar"), "x", F.posexplode("runs").alias("layer", "r"))
    return bars.groupBy("image", "bar", "layer").agg(F.first("r.colour").alias("colour"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.percentile("r.start", 0.5).alias("top"), F.percentile("r.end", 0.5).alias("bottom")).withColumn("layer", F.col("layer") + 1)
