"""Curves and marks from pixel tables (image, x, y, r, g, b) and palettes."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def color_distance(r: int, g: int, b: int) -> Column:
    return F.sqrt(F.pow(F.col("r") - r, 2) + F.pow(F.col("g") - g, 2) + F.pow(F.col("b") - b, 2))


def trace_first_run(pixels: DataFrame, rgb: tuple[int, int, int], distance: float) -> DataFrame:
    """(image, x, y): the median of the first vertical run of a colour in each column."""
    column = Window.partitionBy("image", "x")
    hit = pixels.where(color_distance(*rgb) <= distance).withColumn("_run", F.col("y") - F.row_number().over(column.orderBy("y")))
    first = hit.withColumn("_first", F.min("_run").over(column)).where("_run = _first")
    return first.groupBy("image", "x").agg(F.percentile("y", 0.5).alias("y"))


def trace_unambiguous(pixels: DataFrame, rgb: tuple[int, int, int], distance: float) -> DataFrame:
    """(image, x, y, y_min, y_max, status): columns with one run are READ, those with several AMBIGUOUS without a y."""
    hit = pixels.where(color_distance(*rgb) <= distance).withColumn("_run", F.col("y") - F.row_number().over(Window.partitionBy("image", "x").orderBy("y")))
    got = hit.groupBy("image", "x").agg(F.count_distinct("_run").alias("_n"), F.percentile("y", 0.5).alias("_y"), F.min("y").alias("y_min"), F.max("y").alias("y_max"))
    return got.select("image", "x", F.when(F.col("_n") == 1, F.col("_y")).alias("y"), "y_min", "y_max", F.when(F.col("_n") == 1, "READ").otherwise("AMBIGUOUS").alias("status"))


def nearest_colour(pixels: DataFrame, palette: list[tuple[str, int, int, int]]) -> DataFrame:
    """`pixels` with the name of the nearest palette colour; the palette is a short list."""
    options = F.array(*[F.struct(color_distance(r, g, b).alias("d"), F.lit(n).alias("n")) for n, r, g, b in palette])
    return pixels.withColumn("colour", F.array_min(options)["n"])


def dominant_colour(pixels: DataFrame, group: str, bin_: int = 8) -> DataFrame:
    """(group, r, g, b): medians of the members of the most frequent colour bin, ties to the smallest bin."""
    binned = pixels.withColumn("_bin", F.struct(*[F.floor(F.col(c) / bin_).alias(c) for c in "rgb"]))
    sizes = binned.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_n"), *[F.percentile(c, 0.5).alias(c) for c in "rgb"])
    return sizes.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_n"), "_bin"))).where("_r = 1").select(group, *"rgb")


def components(pixels: DataFrame, image: str = "image", reach: int = 1) -> DataFrame:
    """(image, x, y, component) by 8-neighbourhood, numbered by first pixel in reading order; one image at a time, union-find over its pixels."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        places = sorted(set(zip(pdf["y"].tolist(), pdf["x"].tolist(), strict=True)))
        number = {p: i for i, p in enumerate(places)}
        root = list(range(len(places)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for (y, x), i in number.items():
            for dy in range(-reach, 1):
                for dx in range(-reach, reach + 1):
                    j = number.get((y + dy, x + dx))
                    if j is not None and j < i:
                        a, b = top(i), top(j)
                        root[max(a, b)] = min(a, b)
        names: dict[int, int] = defaultdict(lambda: len(names) + 1)
        return pd.DataFrame({image: pdf[image].iloc[0], "x": [p[1] for p in places], "y": [p[0] for p in places], "component": [names[top(i)] for i in range(len(places))]})

    return pixels.groupBy(image).applyInPandas(run, f"{image} {pixels.schema[image].dataType.simpleString()}, x long, y long, component long")


def longest_stroke(pixels: DataFrame, width: float, share: float) -> DataFrame:
    """Pixels of the one component of an image that spans at least the share of the width; none where several do."""
    parts = components(pixels)
    spans = parts.groupBy("image", "component").agg((F.max("x") - F.min("x") + 1).alias("_w")).where(F.col("_w") >= width * share)
    one = spans.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("image"))).where("_n = 1").select("image", "component")
    return parts.join(one, ["image", "component"])


def eroded_centers(pixels: DataFrame, image: str = "image") -> DataFrame:
    """(image, x, y, n_cores): centre of the pixels whose four neighbours are all set; null where these are several pieces or none."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = set(zip(pdf["x"].tolist(), pdf["y"].tolist(), strict=True))
        left = {p for p in own if all((p[0] + dx, p[1] + dy) in own for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)))}
        pieces: list[list[tuple[int, int]]] = []
        while left:
            piece, todo = [], [left.pop()]
            while todo:
                x, y = todo.pop()
                piece.append((x, y))
                near = {(x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)} & left
                left -= near
                todo += near
            pieces.append(piece)
        center = np.mean(pieces[0], axis=0) if len(pieces) == 1 else (np.nan, np.nan)
        return pd.DataFrame({image: [pdf[image].iloc[0]], "x": [center[0]], "y": [center[1]], "n_cores": [len(pieces)]})

    return pixels.groupBy(image).applyInPandas(run, f"{image} {pixels.schema[image].dataType.simpleString()}, x double, y double, n_cores long")


def pie_share(votes: DataFrame, image: str, angle: str, series: str) -> DataFrame:
    """(image, series, share) from colour votes at each angle (three radii): a series with two votes, alone, owns the angle."""
    tally = votes.groupBy(image, angle, series).agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    sole = tally.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(image, angle))).where("_k = 1")
    angles = votes.groupBy(image).agg(F.count_distinct(angle).alias("_all"))
    return sole.groupBy(image, series).agg(F.count(F.lit(1)).alias("_c")).join(angles, image).select(image, series, (F.col("_c") / F.col("_all")).alias("share"))


def stroke_curve(segments: DataFrame, rgb: tuple[float, float, float], box: tuple[float, float, float, float], least: int = 15, share: float = 0.85, tolerance: float = 0.005) -> DataFrame:
    """(page, n_segments, coverage, status) of vector segments (page, x0, y0, x1, y1, r, g, b) of one colour inside a box: enough segments over enough of its width."""
    bx0, by0, bx1, by1 = box
    near = (F.abs(F.col("r") - rgb[0]) <= tolerance) & (F.abs(F.col("g") - rgb[1]) <= tolerance) & (F.abs(F.col("b") - rgb[2]) <= tolerance)
    inside = F.col("x0").between(bx0, bx1) & F.col("x1").between(bx0, bx1) & F.col("y0").between(by0, by1) & F.col("y1").between(by0, by1)
    own = segments.where(near & inside).select("page", "x0", "y0", "x1", "y1").distinct()
    got = own.groupBy("page").agg(F.count(F.lit(1)).alias("n_segments"), ((F.max(F.greatest("x0", "x1")) - F.min(F.least("x0", "x1"))) / (bx1 - bx0)).alias("coverage"))
    return got.withColumn("status", F.when((F.col("n_segments") >= least) & (F.col("coverage") >= share), "CANDIDATE").otherwise("QUARANTINED"))


def chained_fragments(ends: DataFrame, reach: float) -> DataFrame:
    """(image, left_id, right_id): fragments whose end and start are each other's nearest within reach; mutual choice, so no fragment is used twice.

    ends: image, fragment, x_start, y_start, x_end, y_end. Fragments meet by a grid of the reach, not in all pairs.
    """
    cell = lambda c: F.floor(F.col(c) / reach)
    right = ends.select("image", F.col("fragment").alias("right_id"), F.col("x_start").alias("_xs"), F.col("y_start").alias("_ys"), cell("x_start").alias("_cx"), cell("y_start").alias("_cy"))
    around = F.array(*[F.struct((cell("x_end") + dx).alias("_cx"), (cell("y_end") + dy).alias("_cy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    left = ends.select("image", F.col("fragment").alias("left_id"), "x_end", "y_end", F.explode(around).alias("_c")).select("image", "left_id", "x_end", "y_end", "_c.*")
    met = left.join(right, ["image", "_cx", "_cy"]).where("left_id != right_id AND _xs >= x_end").withColumn("_d", F.sqrt(F.pow(F.col("_xs") - F.col("x_end"), 2) + F.pow(F.col("_ys") - F.col("y_end"), 2))).where(F.col("_d") <= reach)
    first = lambda side, *ties: F.row_number().over(Window.partitionBy("image", side).orderBy("_d", *ties)) == 1
    return met.withColumns({"_l": first("left_id", "right_id"), "_r": first("right_id", "left_id")}).where("_l AND _r").select("image", "left_id", "right_id")


def assembled(tracks: DataFrame, axes: DataFrame) -> DataFrame:
    """`tracks` (panel, curve, x, y) with axis values of their panel; axes: panel, px0, vx0, px1, vx1, py0, vy0, py1, vy1, log_x."""
    from assaylake.functions.transforms import axis_value

    met = tracks.join(axes, "panel")
    c = [F.col(n) for n in ("px0", "vx0", "px1", "vx1")]
    x = F.when(F.col("log_x"), axis_value(F.col("x"), *c, log=True)).otherwise(axis_value(F.col("x"), *c))
    return met.select("panel", "curve", "x", "y", x.alias("value_x"), axis_value(F.col("y"), *[F.col(n) for n in ("py0", "vy0", "py1", "vy1")]).alias("value_y"))


def bars(pixels: DataFrame, rgb: tuple[int, int, int], distance: float, baseline: float, tolerance: float = 3.0, least_width: int = 3) -> DataFrame:
    """(image, bar, x0, x1, top, bottom, status): filled areas of a colour from left to right; those that don't stand on the baseline are DETACHED."""
    parts = components(pixels.where(color_distance(*rgb) <= distance).select("image", "x", "y"))
    box = parts.groupBy("image", "component").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("top"), F.max("y").alias("bottom")).where(F.col("x1") - F.col("x0") + 1 >= least_width)
    place = F.row_number().over(Window.partitionBy("image").orderBy("x0", "top"))
    return box.select("image", place.alias("bar"), "x0", "x1", "top", "bottom", F.when(F.abs(F.col("bottom") - baseline) <= tolerance, "STANDING").otherwise("DETACHED").alias("status"))


def stacked(boxes: DataFrame, gap: float = 1.0) -> DataFrame:
    """`boxes` (image, x0, x1, top, bottom) with their layer in a column of areas, counted from below; a gap between two of them makes the column's layers null."""
    column = Window.partitionBy("image", "x0")
    up = column.orderBy(F.desc("bottom"))
    below = F.lag("top").over(up)
    told = boxes.withColumns({"layer": F.row_number().over(up), "_apart": (below.isNotNull() & (F.abs(below - F.col("bottom")) > gap + 1)).cast("int")})
    return told.withColumn("layer", F.when(F.max("_apart").over(column) == 0, F.col("layer"))).drop("_apart")


def dot_centroids(pixels: DataFrame, rgb: tuple[int, int, int], distance: float, most: int = 400) -> DataFrame:
    """(image, component, x, y, n): centres of the separate spots of a colour; larger areas are no dots."""
    hit = pixels.where(color_distance(*rgb) <= distance).select("image", "x", "y")
    return components(hit).groupBy("image", "component").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).where(F.col("n") <= most)


def colour_mixture(pixels: DataFrame, a: tuple[int, int, int], b: tuple[int, int, int], residual: float) -> DataFrame:
    """`pixels` on the line between two colours with their share of the second: least squares per pixel, clipped to 0..1; others are left out."""
    d = [y - x for x, y in zip(a, b, strict=True)]
    norm = float(sum(x * x for x in d))
    share = sum(((F.col(c) - a[i]) * d[i] for i, c in enumerate("rgb")), F.lit(0.0)) / norm
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    off = F.sqrt(sum((F.pow(F.col(c) - a[i] - F.col("share") * d[i], 2) for i, c in enumerate("rgb")), F.lit(0.0)))
    return pixels.withColumn("share", clipped).where(off <= residual)


def translated_copies(markers: DataFrame) -> DataFrame:
    """(shape, n, x, y, page, marker): markers whose points are the same up to a shift share a shape.

    markers: page, marker, points array<struct(x, y)>; the shape is a hash of the points relative to their corner, so copies meet by an equi-join.
    """
    x0, y0 = F.array_min(F.transform("points", lambda p: p.x)), F.array_min(F.transform("points", lambda p: p.y))
    relative = F.array_join(F.transform(F.array_sort(F.transform("points", lambda p: F.struct(F.round(p.x - x0, 3).alias("x"), F.round(p.y - y0, 3).alias("y")))), lambda p: F.concat_ws(":", p.x.cast("string"), p.y.cast("string"))), ";")
    shaped = markers.select("page", "marker", x0.alias("x"), y0.alias("y"), F.substr(F.sha2(relative.cast("binary"), 256), F.lit(1), F.lit(16)).alias("shape"))
    return shaped.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("shape")))
