"""Pairing, evidence, verdicts and states on literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from assaylake.functions import transforms
from assaylake.operators import control, evidence, merging, ranking, review, scoring


ITEM = "record int, place int, label string, value string, unit string"


def test_items_pair_by_value_then_unit(spark):
    right = [("ms", "1.5", "a"), ("ms", "1.5", "b"), ("wb", "0.4", ""), ("al", None, ""), ("na", "2", "")]
    left = [("ms", "1.50", "b"), ("ms", "1.5", "x"), ("ms", "1.5", "x"), ("wb", "0.5", ""), ("al", "3", ""), ("na", None, ""), ("zz", "1", "")]
    frame = lambda groups: spark.createDataFrame([(g, i, *x) for g, items in enumerate(groups) for i, x in enumerate(items)], ITEM)
    got = review.pair_parameters(frame([left, [("ms", "1", "z")], []]), frame([right, [("ms", "1", "a"), ("ms", "1", "b")], [("t", "x y", "")]]), "record", "place", "label", "value", "unit")
    rows = sorted(((r["record"], r["left_order"], r["right_order"], r["error"]) for r in got.collect()), key=str)
    want = [(0, 0, 1, None), (0, 1, 0, None), (0, 2, None, None), (0, 3, None, "CONFLICT"), (0, 4, None, "CONFLICT"), (0, 5, 4, None), (0, 6, None, None), (0, None, 2, None), (0, None, 3, None), (1, 0, None, "AMBIGUOUS"), (1, None, 0, None), (1, None, 1, None), (2, None, 0, None)]
    assert rows == sorted(want, key=str)


MIX = "paper string, mix int, identity string, source_table string, source_row int, items array<struct<label:string,value:string,unit:string>>, bare boolean"


def mixes(spark, groups):
    return spark.createDataFrame([(p, i, name, *anchor, items, bare) for p, own in groups.items() for i, (name, anchor, items, bare) in enumerate(own)], MIX)


def test_mixes_pair_in_tiers(spark):
    mix = lambda name, anchor=(None, None), items=(), bare=False: (name, anchor, list(items), bare)
    wb = lambda v: ("wb", v, "")
    left = {"p": [mix("A1", ("t1", 3)), mix("C70G30U0"), mix("M10", items=[wb("0.4")]), mix("C70G30", bare=True), mix("Lone")], "q": [mix("x", ("t", 1)), mix("ab", items=[wb("1")])]}
    right = {"p": [mix("zz", ("t1", 3)), mix("c70g30u0"), mix("M1", items=[wb("0.5")]), mix("M10-28", items=[wb("0.40")]), mix("Rest")], "q": [mix("p", ("t", 1)), mix("q", ("t", 1)), mix("abc", items=[wb("1")]), mix("abd", items=[wb("1")])]}
    got = sorted(map(tuple, review.pair_mixes(mixes(spark, left), mixes(spark, right), "paper", "mix").collect()), key=str)
    want = [("p", 0, 0, "ANCHOR", None), ("p", 1, 1, "IDENTITY", None), ("p", 2, 3, "OVERLAP", None), ("p", 4, None, None, None), ("p", None, 2, None, None), ("p", None, 4, None, None)]
    want += [("q", 0, None, None, "AMBIGUOUS_ANCHOR"), ("q", 1, None, None, "AMBIGUOUS_OVERLAP")] + [("q", None, k, None, None) for k in range(4)]
    assert got == sorted(want, key=str)


def test_performance_pairs_in_context_first(spark):
    kind = "record int, place int, name string, value string, unit string, age string, specimen string, method string"
    left = [(1, 0, "Strength", "40", "MPa", "28", "paste", None), (1, 1, "strength", "40", "MPa", "7", None, None), (1, 2, "flow", "200", "mm", None, None, None), (1, 3, "flow", "210", "mm", "1", None, None), (1, 4, "set", "5", "h", None, None, None), (1, 5, "gone", "1", "", None, None, None)]
    right = [(1, 0, "strength", "40.0", "MPa", "28", "Paste", "", None, None), (1, 1, "strength", "40", "MPa", "90", None, None, None, None), (1, 2, "flow", "200", "mm", None, "", None, None, None), (1, 3, "flow", "200", "mm", None, None, None, None, None), (1, 4, "Flow", "0.21", "m", None, None, None, "210", "mm"), (1, 5, "set", "5", "h", "1", None, None, None, None), (1, 6, "set", "5", "h", "2", None, None, None, None)]
    got = review.pair_performance(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind + ", original_value string, original_unit string"), "record", "place")
    rows = {(r["left_order"], r["right_order"], r["tier"], r["error"]) for r in got.collect()}
    assert rows == {(0, 0, "CONTEXT", None), (1, 1, "SCALAR", None), (2, None, None, "AMBIGUOUS_CONTEXT"), (3, 4, "SCALAR", None), (4, None, None, "AMBIGUOUS_SCALAR"), (5, None, None, None), (None, 2, None, None), (None, 3, None, None), (None, 5, None, None), (None, 6, None, None)}


BLOCKS = [("d", "a", 1, 0.0, 10.0, 100.0, 20.0, "The strength was 45"), ("d", "b", 1, 0.0, 30.0, 100.0, 40.0, " MPa after curing."), ("d", "h", 1, 0.0, 0.0, 100.0, 5.0, "Header"), ("d", "c", 2, 0.0, 10.0, 100.0, 20.0, "A sentence that goes on over"), ("d", "n", 2, 0.0, 30.0, 100.0, 40.0, "Figure 3"), ("d", "e", 2, 0.0, 50.0, 100.0, 60.0, "the next block."), ("d", "w", 3, 0.0, 0.0, 1.0, 1.0, "see 45 MPa")]


def test_quotes_are_located_in_tiers(spark):
    blocks = spark.createDataFrame(BLOCKS, "document string, block string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    refs = [("in", "a", "strength was 45", None), ("across", "zz", "was 45 MPa after", None), ("token", "zz", "was 45 MPa after", "MPa after"), ("pieces", "zz", "sentence that goes on over the next block", None), ("words", "zz", None, "45 MPa"), ("near", "e", "45 MPa", "MPa"), ("none", "zz", "not there", "nowhere"), ("cell", "x1", None, None), ("list", "T:1:0", None, "1, 2, 3"), ("short", "T:1:1", None, "2, 3"), ("not", "T:1:0", None, "1, 2, 4"), ("lost", "T:9:9", "Flow mm", None), ("twice", "T:8:8", None, "Flow"), ("next", "zz", None, "curing a"), ("odd", "zz", "a\\Eb", None)]
    rows = spark.createDataFrame([("d", *r) for r in refs], "document string, ref string, cited string, quote string, token string")
    grid = [("x", 0, 0, "x1", "5"), ("T", 1, 0, "T:1:0", "1,"), ("T", 1, 1, "T:1:1", "2,"), ("T", 1, 2, "T:1:2", "3"), ("T", 2, 0, "T:2:0", "Flow"), ("T", 2, 1, "T:2:1", "mm"), ("T", 7, 7, "T:7:7", "Flow")]
    cells = spark.createDataFrame([("d", t, r, c, i, 7, 0.0, 0.0, 1.0, 1.0, text) for t, r, c, i, text in grid], "document string, table_id string, row int, column int, cell string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    found = evidence.locate(rows, blocks, cells).collect()
    got = {r["ref"]: (r["tier"], r["block"], r["page"]) for r in found}
    assert len(found) == len(rows.collect()) and {r["ref"]: r["blocks"] for r in found if r["tier"] in ("cells", "label", "words")} == {"list": ["T:1:0", "T:1:1", "T:1:2"], "short": ["T:1:1", "T:1:2"], "lost": ["T:2:0", "T:2:1"], "twice": ["T:7:7"], "words": ["w"], "next": ["b", "c"]}
    assert got == {"in": ("block", "a", 1), "across": ("document", "a", 1), "token": ("document", "b", 1), "pieces": ("pieces", "c", 2), "words": ("words", "w", 3), "near": ("document", "b", 1), "none": (None, None, None), "cell": ("cell", "x1", 7), "list": ("cells", "T:1:0", 7), "short": ("cells", "T:1:1", 7), "not": ("cell", "T:1:0", 7), "lost": ("label", "T:2:0", 7), "twice": ("label", "T:7:7", 7), "next": ("words", "b", 1), "odd": (None, None, None)}


def test_cells_are_shuffled_once(spark):
    rows = spark.createDataFrame([("d", str(i), f"T:{i}:0", None, None, "", "") for i in range(3)], "document string, ref string, cited string, quote string, token string, q string, k string")
    cells = spark.createDataFrame([("d", "T", 1, 0, "T:1:0", 7, 0.0, 0.0, 1.0, 1.0, "a"), ("d", "U", 1, 0, "T:2:0", 7, 0.0, 0.0, 1.0, 1.0, "b")], "document string, table_id string, row int, column int, cell string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    met = evidence.in_cells(rows, cells)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4, plan  # references to cells with odd ids and to tables, those cells, and all cells by table
    assert {r["ref"]: r["tier"] for r in met.collect()} == {"0": None, "1": "cell", "2": "cell"}


def test_only_lost_cells_take_their_table_along(spark):
    """A cited cell and its row are found by their places, not by a search of the table; labels are read over rows only where no row says them."""
    kind = "document string, ref string, cited string, quote string, token string, q string, k string"
    asked = [("list", "T:1:0", None, "1, 2", "1,2"), ("not", "T:1:0", None, "1, 3", "1,3"), ("row", "T:9:9", "flow mm", None, ""), ("rows", "T:2:9", "flow gone", None, ""), ("none", "T:9:9", "by sea", None, ""), ("odd", "x1", None, None, ""), ("uncited", None, "flow", None, "")]
    rows = spark.createDataFrame([("d", r, c, q, t, "", k) for r, c, q, t, k in asked], kind)
    grid = [("T", 2, 0, "T:2:0", "Flow"), ("T", 2, 1, "T:2:1", "mm"), ("T", 3, 0, "T:3:0", "x"), ("T", 3, 1, "T:3:1", "gone"), ("T", 1, 1, "T:1:1", "2"), ("T", 1, 0, "T:1:0", "1,"), ("U", 1, 0, "x1", "5")]
    cells = spark.createDataFrame([("d", t, r, c, i, 7, 0.0, 0.0, 1.0, 1.0, text) for t, r, c, i, text in grid], "document string, table_id string, row int, column int, cell string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    met = evidence.in_cells(rows, cells)
    assert "array_position(grid" in met._jdf.queryExecution().optimizedPlan().toString()
    got = {r["ref"]: (r["tier"], [b["block"] for b in r["found"] or []]) for r in met.collect()}
    assert got == {"list": ("cells", ["T:1:0", "T:1:1"]), "not": ("cell", ["T:1:0"]), "row": ("label", ["T:2:0", "T:2:1"]), "rows": ("label", ["T:2:0", "T:3:1"]), "none": (None, []), "odd": ("cell", ["x1"]), "uncited": (None, [])}


def test_only_sound_fields_are_shown(spark):
    fields = spark.createDataFrame([("m", "mats", "reported", "1", "e1", False), ("m", "mats", "system_note", "x", None, False), ("n", "mixes", "reported", "2", "e2", False), ("n", "mixes", "evidence_blocked", None, None, True), ("q", "quarantined", "reported", "3", "e3", True)], "card string, card_group string, status string, value string, evidence_key string, repair boolean")
    shown, defects = review.public_fields(fields, spark.createDataFrame([("e1",)], "evidence_key string"))
    assert sorted(r["card"] for r in shown.collect()) == ["m", "n", "n"] and sorted((r["card"], r["defect"]) for r in defects.collect()) == [("n", "NO_PUBLIC_EVIDENCE"), ("n", "REPAIR_STATE")]
    rows = spark.createDataFrame([(None, "not_extracted", None, None, None), (None, "reported", None, "待修复", None), (False, "reported", None, None, "fine")], "b boolean, s string, c string, l string, r string")
    assert [r[0] for r in rows.select(review.waits_for_repair(*[F.col(c) for c in "bsclr"])).collect()] == [True, True, False]
    known, nulls = review.typed_nulls(spark.createDataFrame([("1", None), (None, "not_reported")], "v string, s string"), "v", "s")
    assert known.count() == 1 and [r["s"] for r in nulls.collect()] == ["not_reported"]
    with pytest.raises(Exception, match="unknown null state"):
        review.typed_nulls(spark.createDataFrame([(None, "odd")], "v string, s string"), "v", "s")[1].collect()


def test_preverified_verdicts(spark):
    base = spark.createDataFrame([(20, 10, 50.0, 20)], "n long, n_good long, mean_score double, n_matched long")
    rows = [(i, 60, 2020, f"h{i % 7}", [f"s{i % 6}"], True, True) for i in range(25)]
    members = lambda r: spark.createDataFrame(r, "item int, score int, year int, host string, strata array<string>, matched boolean, verified boolean")
    tell = lambda r, n: scoring.preverified_verdict(base, members(r), n).first()["verdict"]
    assert [tell(rows, 100), tell(rows, 101), tell(rows[:19], 10), tell([(*r[:3], "h", *r[4:]) for r in rows], 10)] == ["PASS", "PARTIAL", "FAIL", "INVALID"]


def test_states_of_deep_graphs_and_lost_outputs(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "p int, c int")
    assert {r["n"]: r["level"] for r in control.levels(edges, spark.range(n + 1).selectExpr("CAST(id AS INT) AS n"), "n", "p", "c").collect()} == {i: i for i in range(n + 1)}
    done = [("LEASE", 0, "a"), ("COMPLETE", 1, "a")]
    assert control.fold_leases([*done, ("LEASE", 2, "b")])["hits"] == 1
    assert control.fold_leases([*done, ("LOST", 2, ""), ("LEASE", 3, "b")], max_attempts=1)["status"] == "leased"
    assert control.fold_leases([("LEASE", 0, "a"), ("LEASE", 1, "a")])["attempts"] == 2


def test_pools_may_not_be_short(spark):
    rows = spark.createDataFrame([(i, "h", ["a"]) for i in range(3)], "i int, h string, s array<string>")
    assert ranking.spread_strata(rows, "h", "s", ["i"], 5).count() == 3
    with pytest.raises(Exception, match="INSUFFICIENT_POOL_COVERAGE"):
        ranking.spread_strata(rows, "h", "s", ["i"], 5, short="error").collect()
    first = ranking.recommended(spark.createDataFrame([(1, False), (2, True), (3, True)], "rank int, open boolean"), "rank", F.col("open"))
    assert [r["rank"] for r in first.where("recommended").collect()] == [2]
    named = ranking.labelled_first(spark.createDataFrame([("g", "a", "x"), ("g", "b", "Mix"), ("h", "c", "y")], "g string, k string, l string"), "g", F.col("l") == "Mix", "k")
    assert sorted((r["g"], r["k"]) for r in named.collect()) == [("g", "b"), ("h", "c")]


def test_settled_classes_and_rebuilt_paths(spark):
    events = spark.createDataFrame([("f", 1, "crash", "high"), ("f", 2, "crash", "low"), ("g", 1, "slow", None)], "f string, n int, kind string, severity string")
    assert [tuple(r) for r in control.unsettled_classes(events, "f", ["kind", "severity"]).collect()] == [("f", "severity")]
    rows = lambda place: spark.createDataFrame([(place, "h1", 1)], "place string, digest string, v int")
    assert merging.same_rows(rows("/a/x"), rows("/b/x")).count() == 2 and merging.same_rows(rows("/a/x"), rows("/b/x"), {"place": "digest"}).count() == 0


def naive_entities(rows):
    """Groups as sets: each row takes in all groups that its aliases lead to and that have its DOI or none."""
    groups, leads = [], {}
    for item, doi, keys in rows:
        near = sorted({id(leads[k]): leads[k] for k in keys if k in leads}.values(), key=lambda g: min(g["items"]))
        near = [g for g in near if doi is None or g["doi"] in (None, doi)]
        own = {"items": {item}, "doi": doi}
        for g in near:
            own = {"items": own["items"] | g["items"], "doi": g["doi"] or own["doi"]}
            groups.remove(g)
        groups.append(own)
        leads = {k: own if any(v is g for g in near) else v for k, v in leads.items()} | dict.fromkeys(keys, own)
    return {i: min(g["items"]) for g in groups for i in g["items"]}


def test_entities_equal_a_naive_version(spark):
    r = random.Random(5)
    rows = [(i, r.choice([None, None, "d1", "d2", "d3"]), r.choice([None, *"abcdefgh"]), r.choice([None, *"uvwxyz"])) for i in range(120)]
    got = merging.resolve_entities(spark.createDataFrame(rows, "item int, doi string, a string, b string"), "item", ["a", "b"], "doi")
    assert {x["item"]: x["entity"] for x in got.collect()} == naive_entities([(i, d, [(n, v) for n, v in (("a", a), ("b", b)) if v]) for i, d, a, b in rows])


def test_entities_are_merged_and_ranked(spark):
    rows = spark.createDataFrame([(1, "k1", None, "t1", 5, ["x"], False), (2, "k1", "d1", "t9", None, ["y"], True), (3, "k2", "d1", "t1", 7, ["z"], False), (4, "k3", "d2", "t4", 9, [], False)], "item int, k string, doi string, t string, v int, tags array<string>, open boolean")
    got = merging.ranked_entities(rows, "item", "k", ["t", "doi"], "doi", ["v", "t"], ["tags"], ["open"], F.col("v") + F.when(F.col("open"), 10).otherwise(0), [F.desc("v")])
    assert [(r["entity"], r["score"], r["tags"], r["n_merged"]) for r in got.collect()] == [("1", 15, ["x", "y", "z"], 2), ("4", 9, [], 1)]


def test_bounds_of_uncertain_axes(spark):
    one = spark.range(1).select(transforms.target_bounds(F.lit(5.0), 0.0, (0.0, 1.0), 10.0, (99.0, 101.0)).alias("t"), transforms.value_bounds(F.lit(50.0), F.lit(51.0), 0.0, (0.0, 1.0), 10.0, (99.0, 101.0)).alias("v")).first()
    assert (one["t"]["low"], one["t"]["high"]) == (49.5, 51.0) and one["v"]["low"] == pytest.approx(4.9) and one["v"]["high"] == pytest.approx(5.151515, abs=1e-5)
    with pytest.raises(ValueError, match="overlap"):
        transforms.target_bounds(F.lit(5.0), 0.0, (0.0, 60.0), 10.0, (50.0, 101.0))
