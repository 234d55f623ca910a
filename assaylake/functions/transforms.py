"""Receipts of conversions, recomputed forwards and backwards, and axis arithmetic."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE, COMPLEMENT, FRACTION, LINEAR, LOG = "unit_scale", "binary_mass_complement_percent", "ratio_to_fraction_percent", "linear_axis_coordinate", "log_axis_percentile"
COMPONENT, PIXEL, DURATIONS = "ratio_component", "linear_pixel_y", "duration_sequence_to_seconds"
KINDS = (SCALE, COMPLEMENT, FRACTION, LINEAR, LOG, COMPONENT, PIXEL, DURATIONS)


def linear(p: Column, p0: Column, v0: Column, p1: Column, v1: Column) -> Column:
    """Value at position p of an axis through (p0, v0) and (p1, v1); null for a degenerate axis."""
    return v0 + F.try_divide(p - p0, p1 - p0) * (v1 - v0)


def axis_value(p: Column, p0: Column, v0: Column, p1: Column, v1: Column, log: bool = False) -> Column:
    """Position to value, in log10 between the anchors if `log`."""
    return F.pow(F.lit(10.0), linear(p, p0, F.log10(v0), p1, F.log10(v1))) if log else linear(p, p0, v0, p1, v1)


def axis_position(v: Column, p0: Column, v0: Column, p1: Column, v1: Column, log: bool = False) -> Column:
    """Value to position."""
    return linear(F.log10(v), F.log10(v0), p0, F.log10(v1), p1) if log else linear(v, v0, p0, v1, p1)


#: A receipt: what went in, what came out, and both recomputations as they were written down. Axes keep their anchors' positions and values (logarithms for LOG).
RECEIPT = (
    "struct<formal: boolean, formula: string, kind: string,"
    " inputs: struct<value: double, scale: double, component_count: int, total: double, components: array<double>, token: string, positions: array<double>, values: array<double>, steps: array<struct<value: double, scale: double>>>,"
    " output: struct<value: double, values: array<double>, component: int>,"
    " forward: struct<computed: double, recorded: double, recorded_list: array<double>, tolerance: double>,"
    " reverse: struct<computed: double, recorded: double, recorded_list: array<double>, computed_token: string, recorded_token: string, tolerance: double>>"
)


def same(a: Column, b: Column, tolerance: Column) -> Column:
    """Whether two numbers agree; two unknown ones do."""
    return F.coalesce(F.abs(a - b) <= F.coalesce(tolerance, F.lit(0.0)), a.isNull() & b.isNull())


def same_lists(a: Column, b: Column, tolerance: Column) -> Column:
    return F.coalesce((F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: same(x, y, tolerance)), lambda x: x), F.lit(False))


def finite(*values: Column) -> Column:
    return F.coalesce(reduce(lambda a, x: a & ~F.isnan(x) & (F.abs(x) < float("inf")), values, F.lit(True)), F.lit(False))


def forward(r: Column) -> Column:
    """array of the outputs that a receipt's inputs give; null for an unknown kind."""
    i, kind = r["inputs"], r["kind"]
    p, v = i["positions"], i["values"]
    axis = linear(i["value"], p[0], v[0], p[1], v[1])
    return (
        F.when(kind == SCALE, F.array(i["value"] * i["scale"])).when(kind == COMPLEMENT, F.array(i["total"] - i["value"])).when(kind == COMPONENT, F.array(F.get(i["components"], r["output"]["component"])))
        .when(kind == FRACTION, F.array(F.try_divide(i["components"][0], i["components"][0] + i["components"][1]) * 100.0)).when(kind == LINEAR, F.array(axis))
        .when(kind == PIXEL, F.array(F.round(linear(i["value"], p[1], v[0], p[0], v[1]), 3))).when(kind == LOG, F.array(F.pow(F.lit(10.0), axis))).when(kind == DURATIONS, F.transform(i["steps"], lambda x: x.value * x.scale))
    )


def backward(r: Column) -> Column:
    """array of the inputs that a receipt's outputs give back; for a fraction the ratio of its parts, for a component nothing."""
    i, o, kind = r["inputs"], r["output"], r["kind"]
    p, v = i["positions"], i["values"]
    return (
        F.when(kind == SCALE, F.array(F.try_divide(o["value"], i["scale"]))).when(kind == COMPLEMENT, F.array(i["total"] - o["value"])).when(kind == FRACTION, F.array(F.try_divide(o["value"], 100.0 - o["value"])))
        .when(kind == LINEAR, F.array(linear(o["value"], v[0], p[0], v[1], p[1]))).when(kind == PIXEL, F.array(linear(o["value"], v[0], p[1], v[1], p[0])))
        .when(kind == LOG, F.array(linear(F.log10(o["value"]), v[0], p[0], v[1], p[1]))).when(kind == DURATIONS, F.zip_with(o["values"], i["steps"], lambda x, s: F.try_divide(x, s.scale)))
    )


def invalid_inputs(r: Column) -> Column:
    """The name of what makes a receipt's numbers no case of its kind; null if they are one."""
    i, kind = r["inputs"], r["kind"]
    p, v, parts, share = i["positions"], i["values"], i["components"], r["output"]["value"]
    mass = (i["component_count"] == 2) & (i["total"] == 100) & finite(i["value"]) & i["value"].between(0, 100)
    ratio = (F.size(parts) == 2) & F.forall(parts, lambda x: finite(x) & (x > 0))
    axis = finite(i["value"], p[0], p[1], v[0], v[1]) & (p[0] != p[1]) & (v[0] != v[1])
    broken = lambda name, good: (kind == name) & ~F.coalesce(good, F.lit(False))
    return (
        F.when(broken(COMPLEMENT, mass), "INVALID_BINARY_MASS_BASIS").when(broken(FRACTION, ratio), "INVALID_STANDARD_RATIO").when(broken(FRACTION, finite(share) & (share > 0) & (share < 100)), "INVALID_STANDARD_FRACTION")
        .when(broken(LINEAR, axis), "INVALID_LINEAR_AXIS")
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed a single time, however often it is read: a variable, which the optimizer does not write out again."""
    return F.transform(F.array(value), use)[0]


def receipt_defects(r: Column, actual: Column, actual_list: Column | None = None) -> Column:
    """Sorted names of what is wrong with a receipt (see RECEIPT) for the value or values that the record holds; empty for a sound one."""
    values = actual_list if actual_list is not None else F.lit(None).cast("array<double>")
    return once(F.struct(r.alias("r"), actual.alias("actual"), values.alias("values")), lambda x: checked_receipt(x["r"], x["actual"], x["values"]))


def checked_receipt(r: Column, actual: Column, actual_list: Column) -> Column:
    kind, i, o, there, back = r["kind"], r["inputs"], r["output"], r["forward"], r["reverse"]
    many = kind == DURATIONS
    parts = F.struct(
        forward(r).alias("made"), backward(r).alias("again"), F.when(many, actual_list).otherwise(F.array(actual)).alias("held"), F.when(many, o["values"]).otherwise(F.array(o["value"])).alias("out"),
        F.when(many, F.transform(i["steps"], lambda x: x.value)).when(kind == FRACTION, F.array(back["recorded"])).otherwise(F.array(i["value"])).alias("source"),
        F.coalesce(kind.isin(*KINDS), F.lit(False)).alias("known"), F.coalesce(kind == COMPONENT, F.lit(False)).alias("single"), F.coalesce(kind.isin(COMPLEMENT, LINEAR), F.lit(False)).alias("told"),
    )
    early = F.when(~F.coalesce(r["formal"] & (r["formula"] != ""), F.lit(False)), "TRANSFORM_NOT_FORMAL_OR_FORMULA_MISSING").when(i.isNull() | o.isNull() | there.isNull() | back.isNull(), "TRANSFORM_RECEIPT_INCOMPLETE").otherwise(invalid_inputs(r))
    full = once(F.struct(early.alias("early")), lambda e: F.when(e["early"].isNotNull(), F.array(e["early"])).otherwise(once(parts, lambda c: compared_receipt(r, c))))
    return F.when(r.isNull(), F.array(F.lit("FORMAL_TRANSFORM_RECEIPT_MISSING"))).otherwise(full)


def compared_receipt(r: Column, c: Column) -> Column:
    """The defects of a complete receipt from its recomputed parts."""
    kind, i, o, there, back = r["kind"], r["inputs"], r["output"], r["forward"], r["reverse"]
    tolerance, back_tolerance, known, single, told = there["tolerance"], back["tolerance"], c["known"], c["single"], c["told"]
    tokens = F.coalesce((back["computed_token"] == i["token"]) & (back["recorded_token"] == i["token"]), F.lit(False))
    recorded = F.when(there["recorded_list"].isNotNull(), same_lists(there["recorded_list"], F.coalesce(o["values"], F.array().cast("array<double>")), tolerance)).otherwise(there["recorded"].isNull() | same(there["recorded"], o["value"], tolerance))
    back_differs = ~same(back["computed"], c["again"][0], back_tolerance)
    found = F.array(
        F.when(~known, F.concat(F.lit("UNKNOWN_TRANSFORM_KIND:"), F.coalesce(kind, F.lit("None")))),
        F.when(known & ~same_lists(c["made"], c["out"], tolerance), "FORWARD_RECOMPUTE_FAILED"),
        F.when(known & F.when(single, ~tokens).otherwise(~same_lists(c["again"], c["source"], back_tolerance)), "REVERSE_RECOMPUTE_FAILED"),
        F.when(known & ~same_lists(c["held"], c["out"], tolerance), "TRANSFORM_OUTPUT_RECORD_DRIFT"),
        F.when(F.when(single, there["recorded"].isNull() | ~same(there["computed"], there["recorded"], tolerance)).otherwise(~recorded | (told & ~same(there["computed"], c["made"][0], tolerance))), "FORWARD_RECEIPT_DRIFT"),
        F.when((told & (back_differs | ~same(back["recorded"], c["source"][0], back_tolerance))) | ((kind == FRACTION) & back_differs), "REVERSE_RECEIPT_DRIFT"),
        F.when(~single & back["recorded"].isNull() & back["recorded_list"].isNull(), "REVERSE_RECEIPT_MISSING"),
    )
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))


def bar_value(top: Column, baseline: Column, axis_zero: Column, slope: Column, low: Column, high: Column, tick: Column, tolerance: float = 3.0) -> Column:
    """Height of a bar on a calibrated axis; null if it doesn't stand on the axis or leaves the ticks by more than one."""
    value = (axis_zero - top) * slope
    return F.when((F.abs(baseline - axis_zero) <= tolerance) & value.between(low - tick, high + tick), value)


def bar_measure(near: Column, far: Column, slope: Column, intercept: Column, ticks: Column, domain_low: Column, domain_high: Column, residual: Column, baseline_value: float = 0.0, endpoint: float = 2.0) -> Column:
    """struct(value, error_scale, status) of a bar between two pixels on an axis value = slope * pixel + intercept with ticks (array of pixels).

    A bar begins within 3 pixels of the baseline, ends within 2 of the plot, and goes at most one tick beyond the ticks; the error
    scale is the endpoint's doubt and the axis' residual in the axis' unit, no statistical interval.
    """
    base = (baseline_value - intercept) / slope
    starts_near = F.abs(near - base) <= F.abs(far - base)
    start, end = F.when(starts_near, near).otherwise(far), F.when(starts_near, far).otherwise(near)
    places = F.array_sort(ticks)
    steps = F.zip_with(F.slice(places, F.lit(2), F.size(places) - 1), F.slice(places, F.lit(1), F.size(places) - 1), lambda b, a: b - a)
    beyond = F.greatest(places[0] - end, end - F.element_at(places, -1), F.lit(0.0))
    status = (
        F.when(F.coalesce(near == far, F.lit(True)), "INVALID_BOX").when(F.abs(start - base) > 3, "NOT_ON_BASELINE").when((end < domain_low - 2) | (end > domain_high + 2), "OUTSIDE_PLOT")
        .when(beyond > F.array_max(steps), "EXTRAPOLATED").otherwise("ESTIMATE")
    )
    good = status == "ESTIMATE"
    return F.struct(F.when(good, F.round(slope * end + intercept, 1)).alias("value"), F.when(good, (endpoint + residual) * F.abs(slope)).alias("error_scale"), status.alias("status"))


def target_bounds(value: Column, v0: float, p0: tuple[float, float], v1: float, p1: tuple[float, float], log: bool = False) -> Column:
    """struct(low, high): the least and greatest position of a value when both anchors' positions are only known to lie in intervals."""
    if not (p0[1] < p1[0] or p1[1] < p0[0]):
        raise ValueError("the anchors' intervals overlap")
    places = F.array(*[axis_position(value, F.lit(float(a)), F.lit(float(v0)), F.lit(float(b)), F.lit(float(v1)), log) for a in p0 for b in p1])
    return F.struct(F.array_min(places).alias("low"), F.array_max(places).alias("high"))


def value_bounds(low: Column, high: Column, v0: float, p0: tuple[float, float], v1: float, p1: tuple[float, float], log: bool = False) -> Column:
    """struct(low, high): the least and greatest value between two positions for anchors in intervals."""
    values = F.array(*[axis_value(p, F.lit(float(a)), F.lit(float(v0)), F.lit(float(b)), F.lit(float(v1)), log) for p in (low, high) for a in p0 for b in p1])
    return F.struct(F.array_min(values).alias("low"), F.array_max(values).alias("high"))


def tick_defect(ticks: Column, log: Column, tolerance: Column) -> Column:
    """What is wrong with an axis' ticks (array<struct(px, value)>), null if they agree with the line through the first and the last."""
    t = F.array_sort(ticks)
    v = F.when(log, F.transform(t, lambda x: F.log10(x.value))).otherwise(F.transform(t, lambda x: x.value))
    n = F.size(t)
    steps = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.struct((F.get(t, i + 1)["px"] - F.get(t, i)["px"]).alias("p"), (F.get(v, i + 1) - F.get(v, i)).alias("v")))
    first, last = F.get(t, 0), F.get(t, n - 1)
    line = F.transform(v, lambda x: linear(x, F.get(v, 0), first["px"], F.get(v, n - 1), last["px"]))
    worst = F.array_max(F.zip_with(line, t, lambda p, x: F.abs(p - x.px)))
    return (
        F.when(n < 3, "TOO_FEW_TICKS").when(F.exists(steps, lambda s: s.p <= 0), "DUPLICATE_PIXEL").when(log & F.exists(t, lambda x: x.value <= 0), "NON_POSITIVE_LOG_TICK")
        .when(~(F.forall(steps, lambda s: s.v > 0) | F.forall(steps, lambda s: s.v < 0)), "NOT_MONOTONIC").when(worst > tolerance, "RESIDUAL")
    )
