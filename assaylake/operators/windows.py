"""Ordered scans: crossings, coverage, bands, runs, budgets, chains. All but the last group are window functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.units import LENGTH


def finer(y: Column, curve_type: Column | None = None, unit: Column | None = None) -> Column:
    """A curve's percentage finer: fractions become percent, coarser becomes finer."""
    percent = y if unit is None else F.when(unit.isin("fraction", "proportion", "0-1", "1"), y * 100).otherwise(y)
    return percent if curve_type is None else F.when(curve_type == "cumulative_coarser", 100 - percent).otherwise(percent)


def sound_curves(points: DataFrame, curve: str, x: str, y: str) -> DataFrame:
    """Points of curves that can be read: two points at least, x strictly rising, y in -0.5..100.5 and never falling by more than 0.5."""
    order = Window.partitionBy(curve).orderBy(x)
    whole = Window.partitionBy(curve)
    steps = points.withColumns({"_dx": F.col(x) - F.lag(x).over(order), "_dy": F.col(y) - F.lag(y).over(order)})
    bad = (F.col("_dx") <= 0) | (F.col("_dy") < -0.5) | ~F.col(y).between(-0.5, 100.5) | F.col(x).isNull() | F.col(y).isNull()
    marked = steps.withColumns({"_bad": F.max(F.coalesce(bad, F.lit(False)).cast("int")).over(whole), "_n": F.count(F.lit(1)).over(whole)})
    return marked.where("_bad = 0 AND _n >= 2").drop("_dx", "_dy", "_bad", "_n")


def percentile_crossings(points: DataFrame, curve: str, x: str, y: str, ordinal: str | None = None, gap: str | None = None, log: bool = False, unit: str = "um", at: tuple[float, ...] = (10.0, 50.0, 90.0)) -> DataFrame:
    """(curve, p, x_value): the one exact hit, else the one strict crossing between points that follow each other in the source without a gap."""
    order = Window.partitionBy(curve).orderBy(x)
    rows = sound_curves(points, curve, x, y)
    lead = {"_x1": F.lead(x).over(order), "_y1": F.lead(y).over(order)}
    if ordinal:
        lead["_o1"] = F.lead(ordinal).over(order)
    if gap:
        lead["_g1"] = F.lead(gap).over(order)
    rows = rows.withColumns(lead).withColumn("p", F.explode(F.array(*map(F.lit, at))))
    exact = F.abs(F.col(y) - F.col("p")) <= 1e-9
    crossing = (F.col(y) < F.col("p")) & (F.col("p") < F.col("_y1"))
    next_to = F.abs(F.col("_o1") - F.col(ordinal)) == 1 if ordinal else F.lit(True)
    if gap:
        later = F.when(F.col("_o1") > F.col(ordinal), F.col("_g1")).otherwise(F.col(gap)) if ordinal else F.col("_g1")
        next_to = next_to & ~F.coalesce(later.cast("boolean"), F.lit(False))
    a, b = (F.log10(x), F.log10("_x1")) if log else (F.col(x), F.col("_x1"))
    read = a + (F.col("p") - F.col(y)) / (F.col("_y1") - F.col(y)) * (b - a)
    read = F.pow(F.lit(10.0), read) if log else read
    hit = rows.groupBy(curve, "p").agg(
        F.count_if(exact).alias("_e"), F.max(F.when(exact, F.col(x))).alias("_ex"), F.count_if(crossing).alias("_c"), F.max(F.when(crossing & next_to, read)).alias("_cx"), F.min(x).alias("_min")
    )
    value = F.when(F.col("_e") == 1, F.col("_ex")).when((F.col("_e") == 0) & (F.col("_c") == 1), F.col("_cx"))
    value = F.when(F.lit(not log) | (F.col("_min") > 0), value) * LENGTH[unit][1]
    return hit.select(curve, "p", value.alias("x_value"))


def curve_coverage(points: DataFrame, curve: str, x: str, y: str, log: bool = False) -> DataFrame:
    """(curve, n_points, covered): five points, from at most 1 to at least 99, no step over 25, no core gap over a quarter of the span."""
    order = Window.partitionBy(curve).orderBy(x)
    at = F.log10(x) if log else F.col(x)
    rows = points.withColumns({"_a": at, "_dy": F.lead(y).over(order) - F.col(y), "_dx": F.lead(at).over(order) - at, "_core": (F.col(y) < 99) & (F.lead(y).over(order) > 1)})
    got = rows.groupBy(curve).agg(
        F.count(F.lit(1)).alias("n_points"), F.min_by(y, x).alias("_y0"), F.max_by(y, x).alias("_y1"), F.max("_dy").alias("_dy"), F.max(F.when(F.col("_core"), F.col("_dx"))).alias("_gap"), (F.max("_a") - F.min("_a")).alias("_span")
    )
    good = (F.col("n_points") >= 5) & (F.col("_y0") <= 1) & (F.col("_y1") >= 99) & (F.coalesce("_dy", F.lit(0.0)) <= 25) & (F.coalesce("_gap", F.lit(0.0)) <= F.col("_span") * 0.25)
    return got.select(curve, "n_points", F.coalesce(good, F.lit(False)).alias("covered"))


def vector_percentile(points: DataFrame, curve: str, x: str, y: str, p: float, max_gap_share: float = 0.08, pad: float = 0.3) -> DataFrame:
    """(curve, p, x_value, x_low, x_high): the one bracket y <= p < next y whose width is a small share of the curve's, and its ends less and plus `pad` (half a stroke, 0.3 at least)."""
    order, whole = Window.partitionBy(curve).orderBy(x, y), Window.partitionBy(curve)
    rows = points.withColumns({"_x1": F.lead(x).over(order), "_y1": F.lead(y).over(order), "_w": F.max(x).over(whole) - F.min(x).over(whole)})
    inside = (F.col(y) <= p) & (F.lit(p) < F.col("_y1"))
    read = F.col(x) + (F.lit(p) - F.col(y)) / (F.col("_y1") - F.col(y)) * (F.col("_x1") - F.col(x))
    narrow = (F.col("_x1") - F.col(x)) <= F.col("_w") * max_gap_share
    kept = lambda c: F.max(F.when(inside & narrow, c))
    got = rows.groupBy(curve).agg(F.count_if(inside).alias("_n"), kept(read).alias("x_value"), kept(F.col(x) - max(pad, 0.3)).alias("x_low"), kept(F.col("_x1") + max(pad, 0.3)).alias("x_high"))
    return got.select(curve, F.lit(p).alias("p"), *[F.when(F.col("_n") == 1, F.col(c)).alias(c) for c in ("x_value", "x_low", "x_high")])


def band_clusters(boxes: DataFrame, group: str, top: str, bottom: str, gap: float, *ties: str) -> DataFrame:
    """`boxes` with the band each belongs to: a new band opens where the top lies more than `gap` below every earlier bottom."""
    order = Window.partitionBy(group).orderBy(top, bottom, *ties)
    before = F.max(bottom).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col(top) > before + gap), 1).otherwise(0)
    return boxes.withColumn("_o", opens).withColumn("band", F.sum("_o").over(order)).drop("_o")


def gap_segments(points: DataFrame, group: str, at: Column | str, gap: float, *ties: str) -> DataFrame:
    """`points` with a segment number that rises where the step from the one before exceeds the gap."""
    order = Window.partitionBy(group).orderBy(at, *ties)
    step = F.col(at) - F.lag(at).over(order) if isinstance(at, str) else at - F.lag(at).over(order)
    return points.withColumn("_n", (F.coalesce(step, F.lit(0.0)) > gap).cast("int")).withColumn("segment", F.sum("_n").over(order) + 1).drop("_n")


def integer_runs(values: DataFrame, group: str, value: str) -> DataFrame:
    """(group, run_start, run_end, n): maximal runs of consecutive integers."""
    distinct = values.select(group, value).distinct()
    island = F.col(value) - F.row_number().over(Window.partitionBy(group).orderBy(value))
    return distinct.withColumn("_i", island).groupBy(group, "_i").agg(F.min(value).alias("run_start"), F.max(value).alias("run_end"), F.count(F.lit(1)).alias("n")).drop("_i")


def chain_defects(stages: DataFrame, route: str, ordinal: str, stage: str, after: str) -> DataFrame:
    """`stages` with `broken`: whether the named predecessor is not the stage before."""
    order = Window.partitionBy(route).orderBy(ordinal)
    return stages.withColumn("broken", ~F.lag(stage).over(order).eqNullSafe(F.col(after)))


def budget_prefix(requests: DataFrame, group: str, order_by: list[str], limits: dict[str, float], repeat: str | None = None) -> DataFrame:
    """The requests before and at the first one at which a running sum reaches its limit or a payload comes again, with the reason there."""
    order = Window.partitionBy(group).orderBy(*order_by)
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = requests.withColumns({f"run_{c}": F.sum(c).over(up_to) for c in limits})
    cases = [F.when(F.col(f"run_{c}") >= limit, F.lit(f"BUDGET_{c.upper()}")) for c, limit in limits.items()]
    if repeat:
        cases.append(F.when(F.row_number().over(Window.partitionBy(group, repeat).orderBy(*order_by)) > 1, F.lit("REPEATED_PAGE")))
    rows = rows.withColumn("stop_reason", F.coalesce(*cases)).withColumn("place", F.row_number().over(order))
    first = F.min(F.when(F.col("stop_reason").isNotNull(), F.col("place"))).over(Window.partitionBy(group))
    return rows.withColumn("_first", first).where("_first IS NULL OR place <= _first").drop("_first")


def signed_cells(cells: DataFrame, table: str = "table_id") -> DataFrame:
    """Minus signs that a parser cut off: neighbouring cells of a row on one baseline, with peers in two other rows whose negative numbers are whole.

    cells: table_id, row, column, id, text, x0, y0, x1, y1.
    """
    order = Window.partitionBy(table, "row").orderBy("column")
    names = ("id", "text", "x0", "y0", "x1", "y1")
    pairs = cells.select(table, "row", *names, *[F.lead(c).over(order).alias(f"n_{c}") for c in names])
    height = F.col("n_y1") - F.col("n_y0")
    cut = pairs.where(
        F.col("text").isin("-", "−", "–") & F.col("n_text").rlike(r"^[0-9]+(\.[0-9]+)?$") & (F.abs(F.col("y0") - F.col("n_y0")) <= 0.5) & (F.abs(F.col("y1") - F.col("n_y1")) <= 0.5)
        & (F.col("n_x0") - F.col("x1")).between(F.lit(0.0), 0.25 * height)
    )
    whole = cells.where(F.col("text").rlike(r"^[-−–][0-9]+(\.[0-9]+)?$")).select(F.col(table).alias("_t"), F.col("row").alias("_row"), F.col("x0").alias("_x0"), F.col("x1").alias("_x1"), F.length("text").alias("_n"))
    near = (F.col(table) == F.col("_t")) & (F.col("row") != F.col("_row")) & (F.abs(F.col("_x0") - F.col("x0")) <= 1) & (F.col("n_x1") <= F.col("_x1") + (F.col("_x1") - F.col("_x0")) / F.col("_n"))
    met = cut.join(whole, near).groupBy(table, F.col("id").alias("sign_id"), F.col("n_id").alias("number_id"), F.concat(F.lit("-"), F.col("n_text")).alias("text")).agg(F.count_distinct("_row").alias("peer_rows"))
    return met.where("peer_rows >= 2")


# Sequential rules that compare with the leader of a group or a best predecessor: grouped Python, one group at a time.


def longest_non_increasing(y: list[float], tolerance: float) -> list[int]:
    """Places of the longest path whose values never rise by more than the tolerance over the one before; ties go to the first found.

    A tree of prefix maxima over the values in falling order holds, for each place passed, its length and how early it came; one lookup finds the best
    place before, so a group costs n log n. Values that are no numbers are on no path.
    """
    values = np.asarray(y, dtype=float)
    known = np.flatnonzero(~np.isnan(values))
    falling, n = -values[known], len(known)
    levels = np.unique(falling)
    own = (np.searchsorted(levels, falling) + 1).tolist()
    reach = np.searchsorted(-(tolerance - levels), falling, side="right").tolist()  # values to which the tolerance may be added to reach this one
    tree, back, size = [0] * (len(levels) + 1), [-1] * n, len(levels) + 1
    best, end = 0, -1
    for i in range(n):
        at, first = reach[i], 0
        while at:
            if tree[at] > first:
                first = tree[at]
            at &= at - 1
        length, early = divmod(first, n) if first else (0, 0)
        if length:
            back[i] = n - 1 - early
        length += 1
        if length > best:
            best, end = length, i
        here, at = length * n + n - 1 - i, own[i]
        while at < size and tree[at] < here:
            tree[at] = here
            at += at & -at
    path = []
    while end >= 0:
        path.append(int(known[end]))
        end = back[end]
    return path[::-1]


def monotone_path(points: DataFrame, group: str, order_by: list[str], y: str, tolerance: float) -> DataFrame:
    """`points` with kept: whether they lie on the group's longest non-increasing path."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_by, kind="stable").reset_index(drop=True)
        chosen = set(longest_non_increasing(pdf[y].tolist(), tolerance))
        return pdf.assign(kept=[i in chosen for i in range(len(pdf))])

    return points.groupBy(group).applyInPandas(run, f"{points._jdf.schema().toDDL()}, kept boolean")


def leader_bands(words: DataFrame, group: str, order_by: list[str], at: str, tolerance: float, name: str = "band") -> DataFrame:
    """`words` with a band number: a word opens a band where it lies beyond the tolerance from the band's first word."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_by, kind="stable").reset_index(drop=True)
        bands, leader, n = [], None, 0
        for v in pdf[at].tolist():
            if leader is None or abs(v - leader) > tolerance:
                leader, n = v, n + 1
            bands.append(n)
        return pdf.assign(**{name: bands})

    return words.groupBy(group).applyInPandas(run, f"{words._jdf.schema().toDDL()}, {name} long")


def stroke_segments(pixels: DataFrame, group: str, x: str, max_gap: int = 2, max_width: int = 10) -> DataFrame:
    """(group, x_start, x_end): pixel runs cut at gaps and where they reach the width, counted from their own start."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        spans: list[list[int]] = []
        for v in sorted(set(pdf[x].tolist())):
            if spans and v - spans[-1][1] <= max_gap and v - spans[-1][0] < max_width:
                spans[-1][1] = v
            else:
                spans.append([v, v])
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(spans), "x_start": [s[0] for s in spans], "x_end": [s[1] for s in spans]})

    return pixels.groupBy(group).applyInPandas(run, f"{group} {pixels.schema[group].dataType.simpleString()}, x_start long, x_end long")



def raster_percentile(points: DataFrame, curve: str, target: float, target_low: float, target_high: float, max_gap: float, pad: float = 2.0) -> DataFrame:
    """(curve, x, x_low, x_high, status, reason) where a pixel curve (x, y, y growing downwards) passes a target row.

    One falling crossing a.y >= target > b.y within the gap is a candidate if the displaced targets (lowest less pad, highest plus pad) have one each too;
    the interval spans all their brackets and the pad.
    """
    order = Window.partitionBy(curve).orderBy("ordinal")
    rows = points.withColumns({"_x1": F.lead("x").over(order), "_y1": F.lead("y").over(order)})
    aims = {"c": target, "l": target_low - pad, "h": target_high + pad}
    cuts = {k: (F.col("y") >= v) & (F.lit(v) > F.col("_y1")) for k, v in aims.items()}
    read = F.col("x") + (F.lit(target) - F.col("y")) / (F.col("_y1") - F.col("y")) * (F.col("_x1") - F.col("x"))
    got = rows.groupBy(curve).agg(
        *[F.count_if(c).alias(f"_n{k}") for k, c in cuts.items()], *[F.max(F.when(c, F.col("_x1") - F.col("x"))).alias(f"_g{k}") for k, c in cuts.items()], *[F.min(F.when(c, F.least("x", "_x1"))).alias(f"_a{k}") for k, c in cuts.items()],
        *[F.max(F.when(c, F.greatest("x", "_x1"))).alias(f"_b{k}") for k, c in cuts.items()], F.max(F.when(cuts["c"], read)).alias("_x"),
    )
    bounded = (F.col("_nl") == 1) & (F.col("_nh") == 1) & (F.col("_gl") <= max_gap) & (F.col("_gh") <= max_gap)
    reason = F.when(F.col("_nc") != 1, "NON_UNIQUE_OR_MISSING_CROSSING").when(F.col("_gc") > max_gap, "DASH_GAP_EXCEEDS_LIMIT").when(~bounded, "UNCERTAINTY_CROSSING_NOT_BOUNDED")
    good = reason.isNull()
    return got.select(
        curve, F.when(good, F.col("_x")).alias("x"), F.when(good, F.least("_ac", "_al", "_ah") - pad).alias("x_low"), F.when(good, F.greatest("_bc", "_bl", "_bh") + pad).alias("x_high"), F.when(good, "CANDIDATE").otherwise("QUARANTINED").alias("status"), reason.alias("reason")
    )


def outline_section(items: DataFrame, curve: str, target: float) -> DataFrame:
    """(curve, x, status): the middle between the two places where the one closed outline is cut by a row.

    items: curve, fragment, closed, ax, ay, bx, by. Curves whose outlines the row misses are left out.
    """
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    hits = items.where(F.col("closed") & (low <= target) & (F.lit(target) < high)).withColumn("_x", F.col("ax") + (F.lit(target) - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay")))
    got = hits.groupBy(curve).agg(F.count_distinct("fragment").alias("_f"), F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_m"))
    one = (F.col("_f") == 1) & (F.col("_n") == 2)
    return got.select(curve, F.when(one, F.col("_m")).alias("x"), F.when(one, "CANDIDATE").otherwise("QUARANTINED").alias("status"))
