"""Typed graphs, scopes, owners, display texts and axes."""

import pytest
from pyspark.sql import functions as F

from assaylake.functions import display, text, transforms
from assaylake.operators import relations


def test_graph_defects(spark):
    nodes = spark.createDataFrame([("m", "mix"), ("t", "method"), ("u", "method")], "node string, node_type string")
    rules = spark.createDataFrame([("tested_by", "mix", "method")], "kind string, source_type string, target_type string")
    edges = spark.createDataFrame([(1, "tested_by", "m", "t", "a"), (2, "tested_by", "m", "x", "b"), (3, "tested_by", "t", "u", "c"), (4, "likes", "m", "t", "d"), (5, "tested_by", "m", "t", "e"), (6, "tested_by", "m", "u", "e")], "edge int, kind string, source string, target string, scope string")
    assert {r["edge"]: r["defect"] for r in relations.graph_defects(edges, nodes, rules).collect()} == {1: None, 2: "DANGLING_ENDPOINT", 3: "ENDPOINT_TYPE", 4: "UNKNOWN_KIND", 5: "CONFLICTING_SCOPE", 6: "CONFLICTING_SCOPE"}


def test_scopes(spark):
    universe = spark.createDataFrame([("g", x) for x in "abc"], "grp string, item string")
    cases = spark.createDataFrame([(1, "g", ["a", "b"], ["c"]), (2, "g", ["a"], ["a", "b", "c"]), (3, "g", ["a"], ["b"]), (4, "g", ["a", "b", "c"], ["d"]), (5, "h", ["a"], [])], "c int, grp string, inc array<string>, exc array<string>")
    members, defects = relations.expand_scope(cases, universe, "c", "grp", "item", "inc", "exc")
    assert sorted(map(tuple, members.collect())) == [(1, "a"), (1, "b")]
    assert dict(map(tuple, defects.collect())) == {2: "OVERLAP", 3: "NOT_COVERED", 4: "FOREIGN_ITEM", 5: "UNKNOWN_GROUP"}


def test_owners(spark):
    owners = spark.createDataFrame([("k1", "A", "mortar"), ("k2", "A", "paste"), ("k3", "B", "paste"), ("k4", "B", "mortar"), ("k5", "B", "mortar")], "owner_key string, label string, specimen string")
    items = spark.createDataFrame([(1, "k1", "mortar"), (2, "k1", "paste"), (3, "k3", "mortar"), (4, "k1", None), (5, "zz", "paste")], "item int, owner_key string, specimen string")
    got = {r["item"]: (r["resolved_owner"], r["status"]) for r in relations.resolve_owners(items, owners, "item").collect()}
    assert got == {1: ("k1", "KEPT"), 2: ("k2", "MOVED"), 3: (None, "AMBIGUOUS"), 4: ("k1", "KEPT"), 5: (None, "UNKNOWN_OWNER")}


BASE = {"record": "r", "name": "strength", "slot_name": "strength", "scope_ids": ["s"], "route_id": "x", "bound_route_id": "x", "row_id": "1", "age_seconds": 60.0, "specimen": "mortar", "method": "EN", "method_sources": ["s"], "specimen_sources": []}


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None), ({"name": "flow"}, "PROPERTY_OUTSIDE_SLOT"), ({"scope_ids": []}, "METHOD_SOURCE_SCOPE_UNSPECIFIED"), ({"route_id": "y", "bound_route_id": None}, "PHYSICAL_ROUTE_UNRESOLVED"), ({"bound_route_id": "z"}, "ROUTE_BINDING_CONFLICT"),
        ({"row_id": "3"}, "ROUTE_SUBJECT_SCOPE_UNRESOLVED"), ({"age_seconds": 61.0}, "ROUTE_AGE_CONFLICT"), ({"route_id": "u", "bound_route_id": None}, "ROUTE_TEST_STAGE_UNRESOLVED"), ({"specimen": None}, "PHYSICAL_OBJECT_UNRESOLVED"),
        ({"specimen": "paste"}, "PHYSICAL_OBJECT_CONFLICT"), ({"method_sources": ["q"]}, "ROUTE_METHOD_SOURCE_UNRESOLVED"), ({"specimen": "halves"}, "PHYSICAL_OBJECT_SOURCE_UNRESOLVED"),
    ],
)
def test_method_scope(spark, change, reason):
    schema = "record string, name string, slot_name string, scope_ids array<string>, route_id string, bound_route_id string, row_id string, age_seconds double, specimen string, method string, method_sources array<string>, specimen_sources array<string>"
    routes = spark.createDataFrame([("r", "x", ["1", "3"], ["3"], 60.0, None, "mortar"), ("r", "u", ["1"], [], None, "UNRESOLVED_TEST_STAGE", "mortar")], "record string, route_id string, row_ids array<string>, excluded_row_ids array<string>, specimen_age_seconds double, stage_status string, specimen_kind string")
    rows = spark.createDataFrame([tuple((BASE | change)[c.split()[0]] for c in schema.split(", "))], schema)
    assert relations.method_scope(rows, routes).first()["reason"] == reason


def test_precursors(spark):
    a = spark.createDataFrame([("m", "p", [70.0, 30.0, 0.0], ["e1", "e2", "e3"]), ("n", "p", [1.0], ["e1", "e2"])], "mix_key string, paper_key string, percents array<double>, evidence_keys array<string>")
    params = spark.createDataFrame([("m", "e1", "Fly Ash"), ("m", "e2", "slag"), ("m", "e3", "none")], "mix_key string, evidence_key string, label string")
    mats = spark.createDataFrame([("p", "mat-1", "flyash"), ("p", "mat-2", "Slag"), ("p", "mat-3", "SLAG")], "paper_key string, mat_key string, custom_id string")
    got = sorted((r["mix_key"], r["mat_key"] or "", r["defect"] or "") for r in relations.precursor_members(a, params, mats).collect())
    assert got == [("m", "", "MATERIAL"), ("m", "mat-1", ""), ("n", "", "ALIGNMENT"), ("n", "", "ALIGNMENT")]


def test_reuse_gate_and_promotion(spark):
    slots = spark.createDataFrame([(1, "r", "/a", ["s"])], "slot int, record string, path string, source_ids array<string>")
    values = spark.createDataFrame([("r", "/a/b", "1", "derived", "r", "s"), ("r", "/ab", "2", None, "r", "s"), ("r", "/a", None, None, "r", "s"), ("r", "/a/c", "3", None, "q", "s"), ("r", "/a/d", "4", None, "r", "t")], "record string, field_path string, value string, method string, evidence_record string, source_id string")
    sources = spark.createDataFrame([("s",), ("t",)], "source_id string")
    assert [tuple(r) for r in relations.reusable_values(slots, values, sources).collect()] == [(1, "/a/b", "1", "derived")]
    items = spark.createDataFrame([("p", True, True), ("p", False, True), ("q", True, True)], "paper string, c boolean, k boolean")
    got = {r["paper"]: (round(r["recall"], 3), r["verdict"]) for r in relations.correctness_gate(items, "paper", F.col("c"), F.col("k"), 0.6, 0.9).collect()}
    assert got == {"p": (0.5, "REJECT"), "q": (1.0, "PASS"), None: (0.667, "PASS")}
    cand = spark.createDataFrame([("c1", "h1"), ("c2", "h2")], "c string, sha string")
    acc = spark.createDataFrame([("h1", "ACCEPTED", []), ("h2", "ACCEPTED", ["x"])], "sha string, verdict string, defects array<string>")
    assert {r["c"]: r["status"] for r in relations.promote(cand, acc, ["sha"]).collect()} == {"c1": "FORMAL", "c2": "CANDIDATE"}
    members = spark.createDataFrame([(1, "p", "h", "ACCEPTED", "k"), (2, "q", "h", "ACCEPTED", "k"), (3, "q", "i", "ISOLATED", "z")], "member int, paper string, content string, status string, record_key string")
    assert tuple(relations.batch_invariants(members).first()) == (3, 1, 1, 1, 1)


def test_display(spark):
    row = spark.range(1).select(*[display.duration(F.lit(float(s)), F.lit(u)).alias(f"d{i}") for i, (s, u) in enumerate([(7200, "h"), (90, None), (86400 * 1.5, "d"), (3600, "x")])], display.shown(F.lit(0.0)), display.shown(F.lit(1234567.8)), display.shown(F.lit(0.5)), display.curing(F.lit("steam"), F.lit(60.0), F.lit(None).cast("double"), F.lit(3600.0)), display.replace_terms(F.lit("fly ash; ash; fly ash"), {"ash": "A", "fly ash": "FA"})).first()
    assert tuple(row) == ("2 h", "90 s", "1.5 d", None, "0.0", "1234568", "0.5", "steam, 60 °C, 1 h", "FA; A")


def test_long_durations_have_six_digits(spark):
    said = {128345400: "128345000 s", 129000600: "129001000 s", 1002600: "1002600 s", 999999: "999999 s", 3600 * 1234567: "1234567 h"}
    got = spark.createDataFrame([(float(s),) for s in said], "s double").select("s", display.duration(F.col("s"))).collect()
    assert {int(r[0]): r[1] for r in got} == said


def test_ticks(spark):
    cases = {"good": [(0.0, 1.0), (10.0, 10.0), (20.0, 100.0)], "few": [(0.0, 1.0), (1.0, 2.0)], "pixel": [(0.0, 1.0), (0.0, 2.0), (1.0, 3.0)], "zero": [(0.0, 0.0), (1.0, 2.0), (2.0, 3.0)], "turn": [(0.0, 1.0), (1.0, 3.0), (2.0, 2.0)], "off": [(0.0, 1.0), (15.0, 10.0), (20.0, 100.0)]}
    rows = spark.createDataFrame(list(cases.items()), "name string, ticks array<struct<px: double, value: double>>")
    got = {r[0]: r[1] for r in rows.select("name", transforms.tick_defect(F.col("ticks"), F.lit(True), F.lit(1.0))).collect()}
    assert got == {"good": None, "few": "TOO_FEW_TICKS", "pixel": "DUPLICATE_PIXEL", "zero": "NON_POSITIVE_LOG_TICK", "turn": "NOT_MONOTONIC", "off": "RESIDUAL"}


def test_component_headers(spark):
    rows = spark.createDataFrame([(h,) for h in ("SiO₂", "Al2O3 + Fe2O3", "LOIa", "LOI", "Others", "Code")], "h string")
    assert [tuple(r) for r in rows.select(text.oxide_label(F.col("h")), text.is_component(F.col("h"))).collect()] == [("SiO2", True), ("Al2O3+Fe2O3", True), ("LOI", True), ("LOI", True), ("Others", True), ("Code", False)]
