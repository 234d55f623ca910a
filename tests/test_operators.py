"""Small fixtures of the relational and sequential operators, against plain Python where it says the rule best."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaylake.operators import claims, contracts, control, graph, matching, merging, pixels, projection, ranking, scoring, windows


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_exactly_one(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "r int, v string")
    assert pairs(contracts.exactly_one(left, right, "k", "r").select("k", "v", "status").fillna("")) == [(1, "a", "EXTRACTED"), (2, "", "AMBIGUOUS"), (3, "", "MISSING")]


def test_set_gates(spark):
    u = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    good = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, p string")
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (4, "b")], "k int, p string")
    assert contracts.partition_gate(u, good, "k", "p").first()["verdict"] == "PASS"
    row = contracts.partition_gate(u, bad, "k", "p").first()
    assert (row["n_missing"], row["n_overlapping"], row["n_foreign"], row["verdict"]) == (2, 1, 1, "REJECT")
    assert pairs(contracts.set_difference(u, bad, "k")) == [(2, "left"), (3, "left"), (4, "right")]
    assert pairs(contracts.unique_keys(bad, "k").select("k", "is_unique").distinct()) == [(1, False), (4, True)]


def test_percentiles(spark):
    rows = [("unique", i, x, y, 0) for i, (x, y) in enumerate([(1.0, 0.0), (2.0, 40.0), (4.0, 60.0), (8.0, 100.0)])]
    rows += [("gap", i, x, y, int(i == 2)) for i, (x, y) in enumerate([(1.0, 0.0), (2.0, 40.0), (4.0, 60.0), (8.0, 100.0)])]
    rows += [("exact", i, x, y, 0) for i, (x, y) in enumerate([(1.0, 10.0), (2.0, 50.0), (4.0, 90.0)])]
    rows += [("falling", i, x, y, 0) for i, (x, y) in enumerate([(1.0, 50.0), (2.0, 10.0)])]
    rows += [("order", o, x, y, 0) for o, x, y in [(0, 1.0, 0.0), (3, 2.0, 40.0), (1, 4.0, 60.0), (2, 8.0, 100.0)]]
    points = spark.createDataFrame(rows, "c string, o int, x double, y double, g int")
    found = {(r["c"], r["p"]): r["x_value"] for r in windows.percentile_crossings(points, "c", "x", "y", "o", "g").collect()}
    assert found["unique", 50.0] == pytest.approx(3.0) and found["gap", 50.0] is None and found["exact", 50.0] == 2.0 and found["exact", 90.0] == 4.0
    assert ("falling", 50.0) not in found and found["order", 50.0] is None and found["unique", 10.0] == pytest.approx(1.25)
    log = {r["p"]: r["x_value"] for r in windows.percentile_crossings(points.where("c = 'unique'"), "c", "x", "y", log=True, unit="mm").collect()}
    assert log[50.0] == pytest.approx(1000 * 8**0.5)


def test_coverage(spark):
    good = [("a", float(i), float(y)) for i, y in enumerate([0, 20, 40, 60, 80, 100])]
    bad = [("b", float(i), float(y)) for i, y in enumerate([0, 50, 100])]
    found = dict((r["c"], r["covered"]) for r in windows.curve_coverage(spark.createDataFrame(good + bad, "c string, x double, y double"), "c", "x", "y").collect())
    assert found == {"a": True, "b": False}


@given(st.lists(st.integers(0, 9), max_size=9), st.sampled_from([0, 1]))
def test_longest_path(values, tolerance):
    path = windows.longest_non_increasing(values, tolerance)
    assert all(values[b] <= values[a] + tolerance for a, b in zip(path, path[1:]))
    best = 0
    for mask in range(1 << len(values)):
        own = [v for i, v in enumerate(values) if mask >> i & 1]
        if all(b <= a + tolerance for a, b in zip(own, own[1:])):
            best = max(best, len(own))
    assert len(path) == best


def test_signed_cells(spark):
    rows = [("t", 0, 0, "a", "-", 10.0, 0.0, 12.0, 10.0), ("t", 0, 1, "b", "5.2", 13.0, 0.0, 25.0, 10.0), ("t", 1, 0, "c", "−4.1", 10.0, 20.0, 25.0, 30.0), ("t", 2, 0, "d", "-4.3", 10.5, 40.0, 25.0, 50.0), ("u", 0, 0, "e", "-", 10.0, 0.0, 12.0, 10.0), ("u", 0, 1, "f", "5", 13.0, 0.0, 25.0, 10.0)]
    cells = spark.createDataFrame(rows, "table_id string, row int, column int, id string, text string, x0 double, y0 double, x1 double, y1 double")
    assert pairs(windows.signed_cells(cells).select("sign_id", "number_id", "text")) == [("a", "b", "-5.2")]


def test_sequential_bands(spark):
    rows = spark.createDataFrame([("g", v) for v in (0.0, 1.5, 2.5, 3.0, 9.0)], "g string, v double")
    assert [b for _, b in pairs(windows.leader_bands(rows, "g", ["v"], "v", 2.0).select("v", "band"))] == [1, 1, 2, 2, 3]
    xs = spark.createDataFrame([("g", x) for x in [0, 1, 2, 6, 7, *range(20, 32)]], "g string, x long")
    assert pairs(windows.stroke_segments(xs, "g", "x")) == [("g", 0, 2), ("g", 6, 7), ("g", 20, 29), ("g", 30, 31)]


def test_components_of_graphs(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)] + [(200, x) for x in range(201, 230)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert dict(pairs(graph.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b"))) == {x: root[x] for x in linked}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_entities_with_contradicting_dois(spark):
    rows = spark.createDataFrame([(1, "t", None, "10.1234/a"), (2, "t", "s", "10.1234/b"), (3, None, "s", None), (4, "u", None, None), (5, "u", "v", "10.1234/c"), (6, None, "v", None)], "i long, title string, sid string, doi string")
    assert pairs(merging.resolve_entities(rows, "i", ["title", "sid"], "doi")) == [(1, 1), (2, 2), (3, 2), (4, 4), (5, 4), (6, 4)]


def test_merging(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string")
    assert pairs(merging.replace_by_key(old, new, "k")) == [(1, "a"), (2, "c")]
    with pytest.raises(ValueError):
        merging.replace_by_key(old, spark.createDataFrame([(9, "x")], "k int, v string"), "k")
    right = spark.createDataFrame([(1, "z"), (2, "b"), (3, "n")], "k int, v string")
    assert pairs(merging.fill_nulls(old, right, "k", "v").select("k", "status")) == [(1, "CONFLICT"), (2, "KEPT"), (3, "FILLED")]
    table, conflicts = merging.insert_if_equal(old, right, "k", "v")
    assert pairs(table) == [(1, "a"), (2, "b"), (3, "n")] and pairs(conflicts) == [(1, "z")]
    assert merging.same_rows(old, old).count() == 0 and pairs(merging.same_rows(old, right)) == [("left", 1), ("right", 2)]
    links = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    assert pairs(merging.rename_evidence(links, spark.createDataFrame([("x", "z")], "old_key string, new_key string"), "k")) == [("y", 2), ("z", 1)]


def test_greedy_selection_equals_the_loop(spark):
    r = random.Random(2)
    rows = [(i, f"h{r.randrange(4)}", [f"s{r.randrange(3)}", f"q{r.randrange(2)}"]) for i in range(60)]
    left, hosts, strata, want = list(rows), {}, {}, []
    while len(want) < 25:
        best = min(left, key=lambda m: (hosts.get(m[1], 0), min(strata.get(s, 0) for s in m[2]), m[0]))
        left.remove(best)
        want.append(best[0])
        hosts[best[1]] = hosts.get(best[1], 0) + 1
        for s in best[2]:
            strata[s] = strata.get(s, 0) + 1
    got = ranking.spread_strata(spark.createDataFrame(rows, "i int, h string, s array<string>"), "h", "s", ["i"], 25)
    assert [i for _, i in pairs(got.select("pick", "i"))] == want


def test_shards(spark):
    rows = spark.createDataFrame([(i, w) for i, w in enumerate([9, 7, 6, 5, 4, 1])], "i int, w int")
    found = dict(pairs(ranking.balanced_shards(rows, "i", "w", 2)))
    assert found == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1, 5: 0}
    even = pairs(ranking.even_shards(spark.range(10).withColumnRenamed("id", "i"), "i", 3))
    assert [s for _, s in even] == [0] * 3 + [1] * 3 + [2] * 4


def test_matching(spark):
    paths = spark.createDataFrame([("/a/b/c",), ("/x",)], "path string")
    prefixes = spark.createDataFrame([("/a",), ("/a/b",), ("/a/bc",)], "p string")
    assert pairs(matching.longest_prefix(paths, prefixes, "path", "p").fillna("-")) == [("/a/b/c", "/a/b"), ("/x", "-")]
    quotes = spark.createDataFrame([(1, "Hello wor-ld"), (2, "absent"), (3, "beta")], "q int, t string")
    texts = spark.createDataFrame([(10, "say hello world"), (11, "Alpha beta")], "b int, t string")
    want = [(1, 10, 2, 4), (3, 11, 1, 7)]
    assert pairs(matching.located_quotes(quotes, texts, "q", "t", "b", "t")) == want
    limit, matching.MAX_QUOTE_BYTES = matching.MAX_QUOTE_BYTES, 0
    try:
        assert pairs(matching.located_quotes(quotes, texts, "q", "t", "b", "t")) == want
    finally:
        matching.MAX_QUOTE_BYTES = limit
    cells = spark.createDataFrame([("r", 1, 10.0), ("r", 2, 11.0)], "row string, cell int, at double")
    heads = spark.createDataFrame([("r", 7, 10.9), ("r", 8, 30.0)], "row string, head int, at double")
    assert [(a, b, c) for a, b, c, _ in pairs(matching.greedy_pairs(cells, heads, "row", "cell", "head", "at", 50.0))] == [("r", 1, 8), ("r", 2, 7)]
    boxes = spark.createDataFrame([(1, 5, 0.0, 0.0, 100.0, 10.0), (1, 6, 90.0, 0.0, 200.0, 10.0)], "page int, box_id int, x0 double, y0 double, x1 double, y1 double")
    tokens = spark.createDataFrame([(1, 1, 95.0, 5.0), (1, 2, 150.0, 5.0), (2, 3, 50.0, 5.0)], "page int, token_id int, x double, y double")
    assert pairs(matching.boxes_holding(tokens, boxes).select("token_id", "box_id")) == [(1, 5), (1, 6), (2, 6)]


def test_claims(spark):
    rows = spark.createDataFrame([("1", '{"a": {"b~/": [1, {"c": null}]}, "e": {}, "f": "x"}')], "k string, j string")
    assert pairs(claims.flatten_json(rows, "k", "j").select("field_path", "value").fillna("null")) == [("/a/b~0~1/0", "1"), ("/a/b~0~1/1/c", "null"), ("/e", "{}"), ("/f", "x")]
    again = spark.createDataFrame([(1, "r", "f"), (2, "r", "f"), (3, "r", "g")], "at int, run string, fp string")
    assert [s for _, s in pairs(claims.repeated_defects(again, "run", "fp", "at").select("at", "stop"))] == [False, True, False]


def test_control(spark):
    assert control.fold_leases([("LEASE", 0, "a"), ("LEASE", 1, "b"), ("COMPLETE", 2, "b"), ("COMPLETE", 3, "a")]) | {"expires": 0} == control.START | {"status": "succeeded", "expires": 0, "attempts": 1, "refused": 2}
    assert control.fold_leases([("LEASE", 0, "a"), ("LEASE", 70, "b"), ("FAIL", 71, "b"), ("LEASE", 72, "c"), ("FAIL", 73, "c"), ("LEASE", 74, "d")])["status"] == "dead_letter"
    events = spark.createDataFrame([("f", 1, "OBSERVED"), ("f", 2, "VERIFIED"), ("f", 3, "RESOLVED"), ("f", 4, "NOISE"), ("g", 1, "RESOLVED")], "f string, n int, e string")
    found = {(r["f"], r["n"]): r["error"] for r in control.fault_transitions(events, "f", "e", ["n"]).collect()}
    assert found == {("f", 1): None, ("f", 2): "VERIFIED_WITHOUT_RESOLVED", ("f", 3): "NOT_OPEN", ("f", 4): "UNKNOWN_EVENT", ("g", 1): "FIRST_EVENT"}
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "p string, c string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "n string")
    assert pairs(control.levels(edges, nodes, "n", "p", "c")) == [("a", 0), ("b", 1), ("c", 2), ("d", 0)]
    with pytest.raises(ValueError):
        control.levels(edges.union(spark.createDataFrame([("c", "a")], "p string, c string")), nodes, "n", "p", "c")


def test_pixels(spark):
    red = [("i", x, y, 250, 0, 0) for x, y in [(0, 5), (0, 6), (0, 9), (1, 6), (2, 7)]] + [("i", 8, 1, 250, 0, 0), ("i", 3, 3, 0, 0, 250)]
    rows = spark.createDataFrame(red, "image string, x long, y long, r int, g int, b int")
    assert pairs(pixels.trace_first_run(rows, (255, 0, 0), 20.0).select("x", "y")) == [(0, 5.5), (1, 6.0), (2, 7.0), (8, 1.0)]
    assert {r["x"]: r["status"] for r in pixels.trace_unambiguous(rows, (255, 0, 0), 20.0).collect()} == {0: "AMBIGUOUS", 1: "READ", 2: "READ", 8: "READ"}
    assert {r["colour"] for r in pixels.nearest_colour(rows, [("red", 255, 0, 0), ("blue", 0, 0, 255)]).collect()} == {"red", "blue"}
    parts = pixels.components(rows.where("r = 250"))
    assert parts.select("component").distinct().count() == 3
    assert {(r["x"], r["y"]) for r in pixels.longest_stroke(rows.where("r = 250"), 9.0, 0.3).collect()} == {(0, 5), (0, 6), (1, 6), (2, 7)}
    square = spark.createDataFrame([("m", x, y) for x in range(5) for y in range(5)], "image string, x long, y long")
    assert tuple(pixels.eroded_centers(square).first()) == ("m", 2.0, 2.0, 1)
    assert pixels.dominant_colour(rows, "image").first()["r"] == 250
    votes = spark.createDataFrame([("p", a, s) for a in range(4) for s in (["x", "x", "y"] if a < 3 else ["y", "y", "x"])], "image string, angle int, s string")
    assert pairs(pixels.pie_share(votes, "image", "angle", "s")) == [("p", "x", 0.75), ("p", "y", 0.25)]


def test_scores_and_gates(spark):
    row = spark.range(1).select(*[scoring.gate(F.lit(c), F.lit(p)).alias(n) for n, c, p in (("a", True, True), ("b", False, True), ("c", True, False))]).first()
    assert tuple(row) == ("PASS", "INCOMPLETE", "FAIL")
    facts = spark.createDataFrame([("m", "a"), ("m", "b")], "mix string, s string")
    out = projection.specimen_variants(spark.createDataFrame([("m",)], "mix string"), facts, "mix", "s")
    assert out.select("variant_key").distinct().count() == 2


def test_nearest_column_reads_no_frame_to_its_end_for_each_row(spark):
    left, right = [("s", float(i), i) for i in range(40)] + [("t", 1.0, 40), ("u", None, 41)], [("s", 3.0), ("s", 10.0), ("s", 30.0), ("t", 5.0), ("v", 0.0)]
    got = matching.nearest_before_and_after(spark.createDataFrame(left, "scope string, at double, id int"), spark.createDataFrame(right, "scope string, at double"), "scope", "at", "near", ("id",))
    plan = got._jdf.queryExecution().executedPlan().toString()
    want = {i: min((abs(at - v), v) for s, v in right if s == scope)[1] if at is not None and any(s == scope for s, _ in right) else None for scope, at, i in left}
    assert {r["id"]: r["near"] for r in got.collect()} == want
    assert "unboundedfollowing" not in plan.lower()



@pytest.mark.parametrize("row", [("place",), None])
def test_nearest_anchor_meets_no_pairs(spark, row):
    r = random.Random(3)
    some = lambda n: [(i, r.choice([0, 0, 0, 1, None]), r.choice([1, 2, 3, None]), r.choice("abc"), r.choice([*range(12), None])) for i in range(n)]
    schema = "id int, scope int, k int, kind string, place int"
    left, right = some(150), some(60)
    got = matching.nearest_anchor(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "scope", "id", "id", ["k", "kind"], row=row)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = []
    for i, scope, k, kind, at in left:
        met = []
        for j, other, k2, kind2, at2 in right:
            tier = 1 if k is not None and k == k2 else 2 if kind == kind2 else None
            if scope is not None and scope == other and tier:
                d = 0 if row is None else None if at is None or at2 is None else abs(at - at2)
                place = 0 if row is None else -1 if at2 is None else at2
                met.append((tier, -1 if d is None else d, place, j, d))
        if met:
            best = min(met)
            want.append((scope, i, best[3], best[0], best[4]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
