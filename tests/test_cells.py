"""Cells, anchors, percentiles with envelopes, vector strokes, resumption, cached pages."""

import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assaylake.operators import cells, control, pixels, windows
from assaylake.sources import ooxml, pages

GRID = [["Property", "A", "B"], ["Flow", "10", "12"], ["Strength", "30", "40"]]


def frame(spark, name, rows):
    return spark.createDataFrame([(name, f"{name}:{r}:{c}", r, c, t) for r, line in enumerate(rows) for c, t in enumerate(line)], "table_id string, id string, row int, column int, text string")


def test_property_cells_in_both_orientations(spark):
    turned = [list(x) for x in zip(*GRID)]
    own = frame(spark, "t", GRID).unionByName(frame(spark, "u", turned))
    wanted = spark.createDataFrame([(1, "t", "B", "Strength"), (2, "u", "B", "Strength"), (3, "t", "C", "Flow")], "request int, table_id string, specimen string, property string")
    assert sorted((r["request"], r["text"], r["n_hits"]) for r in cells.property_cells(own, wanted).collect()) == [(1, "40", 1), (2, "40", 1)]


def test_anchors(spark):
    own = frame(spark, "t", [["Mix", "Compressive", "strength", "Flow"], ["code", "28", "d", "mm"], ["M1", "41", "x", "180"], ["M1", "7", "", "Flow of mortar"]])
    asked = spark.createDataFrame([("t", 1, ["t:2:0"], ""), ("t", 2, [], "compressive strength"), ("t", 3, ["t:9:3"], "Flow mm"), ("t", 4, [], "of mortar"), ("t", 5, ["t:3:0x"], "M1"), ("t", 6, ["q:3:0"], "M1"), ("t", 7, [], "nowhere")], "table_id string, anchor int, ids array<string>, label string")
    got = {r["anchor"]: (r["ids"], r["status"]) for r in cells.resolve_anchors(own, asked).collect()}
    assert got[1] == (["t:2:0"], "RESOLVED") and got[2][0] == ["t:0:1", "t:0:2"] and got[4][0] == ["t:3:3"] and got[5][0] == ["t:2:0"] and got[6][0] == ["t:3:0"] and got[7] == (None, "NOT_FOUND")


def test_tables_order_and_backends(spark):
    captions = spark.createDataFrame([("d", "t", "Table 1. Mix proportions"), ("d", "v", "Table 2. Oxides")], "document string, table_id string, caption string")
    known = spark.createDataFrame([("Flow",), ("Strength",)], "label string")
    assert [tuple(r) for r in cells.one_table(captions, frame(spark, "t", GRID), "(?i)mix", known).collect()] == [("d", "t", "SELECTED")]
    blocks = spark.createDataFrame([("d", 1, "r", 110.0, 5.0, 200.0), ("d", 1, "l2", 0.0, 50.0, 90.0), ("d", 1, "l1", 0.0, 5.0, 90.0)], "document string, page int, b string, x0 double, y0 double, x1 double")
    assert [r["b"] for r in cells.reading_order(blocks).orderBy("place").collect()] == ["l1", "l2", "r"]
    panels = spark.createDataFrame([("f", 1, "curve", True, 0.0, 0.0, 1.0, 1.0), ("f", 2, "bar", False, 2.0, 0.0, 3.0, 1.0), ("g", 1, "curve", True, 0.0, 0.0, 2.0, 2.0), ("g", 2, "bar", False, 1.0, 1.0, 3.0, 3.0)], "figure string, panel int, kind string, has_vectors boolean, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r["figure"], r["panel"], r["backend"]) for r in cells.chart_backend(panels).collect()) == [("f", 1, "vector"), ("f", 2, "bars"), ("g", 1, "manual"), ("g", 2, "manual")]


def test_repairs(spark):
    errors = spark.createDataFrame([(i, ["a", "b"], "f", "MULTIPLE") for i in range(5)], "fact int, owners array<string>, field string, error string")
    fixes = spark.createDataFrame([(0, ["b", "a"], "f", "12", "is 12 MPa", None), (1, ["a"], "f", "12", "12", None), (2, ["a", "b"], "g", "12", "12", None), (3, ["a", "b"], "f", "13", "12", None)], "fact int, owners array<string>, field string, text string, source_text string, error string")
    got = {r["fact"]: r["reason"] for r in cells.accepted_repairs(errors, fixes, 40).collect()}
    assert got == {0: None, 1: "OWNERS_CHANGED", 2: "FIELD_CHANGED", 3: "TOKEN_NOT_IN_SOURCE", 4: "NO_REPLACEMENT"}
    assert {r["reason"] for r in cells.accepted_repairs(errors, fixes, 10).collect()} == {"BUDGET"}


def test_raster_and_outline_percentiles(spark):
    rows = [("good", i, 10.0 * i, 100.0 - 10 * i) for i in range(11)] + [("twice", i, 10.0 * i, y) for i, y in enumerate([100.0, 40.0, 90.0, 30.0])] + [("wide", 0, 0.0, 100.0), ("wide", 1, 90.0, 0.0)]
    points = spark.createDataFrame(rows, "c string, ordinal int, x double, y double")
    got = {r["c"]: r for r in windows.raster_percentile(points, "c", 55.0, 54.0, 56.0, 30.0).collect()}
    assert got["good"]["x"] == pytest.approx(45.0) and got["good"]["x_low"] == 38.0 and got["good"]["x_high"] == 52.0
    assert got["twice"]["reason"] == "NON_UNIQUE_OR_MISSING_CROSSING" and got["wide"]["reason"] == "DASH_GAP_EXCEEDS_LIMIT"
    items = spark.createDataFrame([("c", 1, True, 0.0, 0.0, 0.0, 10.0), ("c", 1, True, 4.0, 10.0, 4.0, 0.0), ("d", 1, True, 0.0, 0.0, 0.0, 10.0)], "c string, fragment int, closed boolean, ax double, ay double, bx double, by double")
    assert {r["c"]: (r["x"], r["status"]) for r in windows.outline_section(items, "c", 5.0).collect()} == {"c": (2.0, "CANDIDATE"), "d": (None, "QUARANTINED")}


def test_strokes_and_fragments(spark):
    segments = [(1, float(i), 5.0, float(i + 1), 6.0, 1.0, 0.0, 0.0) for i in range(18)] + [(2, 0.0, 5.0, 19.0, 6.0, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(segments, "page int, x0 double, y0 double, x1 double, y1 double, r double, g double, b double")
    assert {r["page"]: r["status"] for r in pixels.stroke_curve(df, (1.0, 0.0, 0.0), (0.0, 0.0, 20.0, 10.0)).collect()} == {1: "CANDIDATE", 2: "QUARANTINED"}
    ends = spark.createDataFrame([("i", 1, 0.0, 0.0, 10.0, 0.0), ("i", 2, 12.0, 0.0, 20.0, 0.0), ("i", 3, 13.0, 0.5, 20.0, 9.0), ("i", 4, 90.0, 0.0, 99.0, 0.0)], "image string, fragment int, x_start double, y_start double, x_end double, y_end double")
    assert [tuple(r) for r in pixels.chained_fragments(ends, 5.0).collect()] == [("i", 1, 2)]
    axes = spark.createDataFrame([("p", 0.0, 1.0, 100.0, 100.0, 0.0, 100.0, 100.0, 0.0, True)], "panel string, px0 double, vx0 double, px1 double, vx1 double, py0 double, vy0 double, py1 double, vy1 double, log_x boolean")
    row = pixels.assembled(spark.createDataFrame([("p", "c", 50.0, 25.0)], "panel string, curve string, x double, y double"), axes).first()
    assert (row["value_x"], row["value_y"]) == (pytest.approx(10.0), pytest.approx(75.0))


def test_resume_and_tasks(spark, tmp_path):
    members = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "member int, content string")
    done = spark.createDataFrame([(1, "a", "v1", "DONE"), (2, "x", "v1", "DONE"), (3, "c", "v0", "DONE"), (4, "d", "v1", "FAILED")], "member int, content string, config string, status string")
    assert {r["member"]: r["action"] for r in control.resume(members, done, "v1").collect()} == {1: "REUSE", 2: "REDO", 3: "REDO", 4: "RUN"}
    tasks = spark.createDataFrame([("a", "ka"), ("b", "kb"), ("c", "kc"), ("d", "kd"), ("e", "ke")], "task string, cache_key string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "parent string, child string")
    results = spark.createDataFrame([("ka", "DONE"), ("kd", "FAILED")], "cache_key string, status string")
    assert {r["task"]: r["state"] for r in control.ready_tasks(tasks, edges, results).collect()} == {"a": "CACHED", "b": "READY", "c": "WAITING", "d": "READY", "e": "BLOCKED"}
    path = str(tmp_path / "claims")
    control.replace_run(spark.createDataFrame([("r1", 1), ("r2", 2)], "run_id string, v int"), path)
    control.replace_run(spark.createDataFrame([("r2", 3)], "run_id string, v int"), path)
    assert sorted((r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("r1", 1), ("r2", 3)]
    one = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a")], "grp string, o int, d string")
    assert control.sealed(one, "grp", "o", "d").first()["seal"] == control.sealed(one.orderBy("o"), "grp", "o", "d").first()["seal"]


def test_pages_and_documents(spark):
    import hashlib

    sha = hashlib.sha256(b"{}").hexdigest()
    requests = spark.createDataFrame([(u, "v1") for u in "abcde"], "url_sha256 string, contract string")
    t = datetime(2024, 1, 20)
    receipts = spark.createDataFrame([("a", "v1", "OK", t, sha), ("b", "v1", "OK", datetime(2023, 1, 1), sha), ("c", "v1", "TERMINAL_FAILURE", t, None), ("d", "v0", "OK", t, sha), ("e", "v1", "OK", t, "bad")], "url_sha256 string, contract string, status string, fetched_at timestamp, payload_sha256 string")
    payloads = spark.createDataFrame([(sha, "{}"), ("bad", "x")], "payload_sha256 string, payload string")
    got = {r["url_sha256"]: r["source"] for r in pages.usable_pages(requests, receipts, payloads, F.lit(datetime(2024, 1, 31))).collect()}
    assert got == {"a": "CACHE", "b": "FETCH", "c": "REPLAYED_FAILURE", "d": "FETCH", "e": "FETCH"}
    files = spark.createDataFrame([("a", bytearray(b"%PDF-1.7 x")), ("b", bytearray(b"<html>"))], "path string, content binary")
    assert {r["path"]: r["status"] for r in pages.checked_documents(files).collect()} == {"a": "ACCEPTED", "b": "NOT_A_PDF"}
    rows = spark.createDataFrame([("x", "see https://e.org"), ("y", "clean")], "id string, note string")
    assert pages.leaks(rows).count() == 1 and pages.leaks(pages.body_free(rows, ["note"], ["id"])).count() == 0
    text = spark.createDataFrame([("d", 1, "t"), ("d", 1, "t")], "document string, page int, text string")
    assert pages.source_inventory({"text": text, "table": text}).count() == 2


def test_native_charts(spark):
    c = ooxml.CHART[1:-1]
    part = f'<c:chartSpace xmlns:c="{c}"><c:ser><c:tx><c:strRef><c:strCache><c:pt idx="0"><c:v>S</c:v></c:pt></c:strCache></c:strRef></c:tx><c:errBars><c:plus><c:numLit><c:pt idx="0"><c:v>0.5</c:v></c:pt></c:numLit></c:plus></c:errBars><c:cat><c:strRef><c:strCache><c:pt idx="0"><c:v>A</c:v></c:pt></c:strCache></c:strRef></c:cat><c:val><c:numRef><c:numCache><c:pt idx="0"><c:v>3</c:v></c:pt></c:numCache></c:numRef></c:val></c:ser></c:chartSpace>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/charts/chart1.xml", part)
    row = ooxml.native_charts(spark.createDataFrame([("f", bytearray(out.getvalue()))], "path string, content binary")).first()
    assert (row["series"], row["category"], row["value"], row["minus"], row["plus"]) == ("S", "A", 3.0, None, 0.5)


def test_bars_dots_and_copies(spark):
    area = lambda xs, ys, rgb: [("i", x, y, *rgb) for x in xs for y in ys]
    rows = area(range(0, 5), range(10, 21), (255, 0, 0)) + area(range(10, 15), range(5, 21), (255, 0, 0)) + area(range(20, 25), range(2, 8), (255, 0, 0)) + area([30], [3], (0, 0, 255)) + area(range(0, 5), range(4, 10), (0, 255, 0))
    px = spark.createDataFrame(rows, "image string, x long, y long, r int, g int, b int")
    got = [(r["bar"], r["x0"], r["top"], r["status"]) for r in pixels.bars(px, (255, 0, 0), 10.0, 20.0).orderBy("bar").collect()]
    assert got == [(1, 0, 10, "STANDING"), (2, 10, 5, "STANDING"), (3, 20, 2, "DETACHED")]
    boxes = spark.createDataFrame([("i", 0, 4, 10, 20), ("i", 0, 4, 4, 9), ("i", 10, 14, 10, 20), ("i", 10, 14, 0, 5)], "image string, x0 int, x1 int, top int, bottom int")
    assert sorted((r["x0"], r["top"], r["layer"] or 0) for r in pixels.stacked(boxes).collect()) == [(0, 4, 2), (0, 10, 1), (10, 0, 0), (10, 10, 0)]
    assert [(r["x"], r["y"], r["n"]) for r in pixels.dot_centroids(px, (0, 0, 255), 10.0).collect()] == [(30.0, 3.0, 1)]
    mixed = spark.createDataFrame([("m", 0, 0, 128, 0, 127), ("m", 1, 0, 128, 90, 127)], "image string, x long, y long, r int, g int, b int")
    assert [round(r["share"], 2) for r in pixels.colour_mixture(mixed, (255, 0, 0), (0, 0, 255), 5.0).collect()] == [0.5]
    marks = spark.createDataFrame([(1, 1, [(0.0, 0.0), (1.0, 2.0)]), (1, 2, [(6.0, 7.0), (5.0, 5.0)]), (1, 3, [(0.0, 0.0), (2.0, 2.0)])], "page int, marker int, points array<struct<x: double, y: double>>")
    assert {r["marker"]: r["n"] for r in pixels.translated_copies(marks).collect()} == {1: 2, 2: 2, 3: 1}


def test_respective_pairs_and_phases(spark):
    from assaylake.functions import text

    rows = spark.createDataFrame([(1, "FA and GGBS had d50 of 12.5 um and 15 um, respectively."), (2, "A, B and C had d50 of 1 um and 2 um, respectively"), (3, "FA and FA were 1 um and 2 um respectively"), (4, "plain")], "i int, t string")
    got = {r["i"]: [tuple(p) for p in r["p"]] for r in rows.select("i", text.respective_pairs(F.col("t")).alias("p")).collect()}
    assert got == {1: [("FA", 12.5, "um"), ("GGBS", 15.0, "um")], 2: [], 3: [], 4: []}
    row = spark.range(1).select(text.phase_shares(F.lit("Quartz 20.5 %, Mullite (9.5 wt.%) and Amorphous 70%"))).first()[0]
    assert row["shares"] == {"Quartz": 20.5, "Mullite": 9.5, "Amorphous": 70.0} and row["complete"]
