"""Mirrors, downloads, lists of values and frozen orders on literal cases."""

import re

from pyspark.sql import functions as F

from assaylake.functions import text
from assaylake.operators import matching, relations
from assaylake.sources import fetch


def test_mirrors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k int, c string")
    got = relations.mirror_defects(frame([(1, "a"), (1, "b"), (2, "x"), (3, "y"), (3, "y")]), frame([(1, "b"), (1, "a"), (3, "y"), (4, "z")]), "k", "c").collect()
    assert {(r["k"], r["defect"]) for r in got} == {(2, "NOT_MIRRORED"), (3, "HASH_DIFFERS"), (4, "NOT_PUBLISHED")}


def test_downloads(spark):
    bodies = {"https://a.org/ok": b"%PDF-1.7 text", "https://a.org/html": b"<html>", "https://a.org/big": b"%PDF-" + b"x" * 200}

    def transport(url, timeout):
        return (200, {}, bodies[url]) if url in bodies else (503, {}, b"")

    rows = spark.createDataFrame([(u,) for u in (*bodies, "https://a.org/ok", "https://b.org/x", "http://a.org/ok", "https://a.org/busy")], "url string")
    got = {r["url"]: r for r in fetch.fetch_documents(rows, transport, ("a.org",), most_bytes=100, sleep=lambda s: None).collect()}
    assert {u.rpartition("/")[2] + u[:5]: (r["status"], r["error"]) for u, r in got.items()} == {"okhttps": ("OK", None), "htmlhttps": ("TERMINAL_FAILURE", "NOT_A_PDF"), "bighttps": ("TERMINAL_FAILURE", "TOO_LARGE"), "xhttps": ("TERMINAL_FAILURE", "HOST_NOT_ALLOWED"), "okhttp:": ("TERMINAL_FAILURE", "NOT_HTTPS"), "busyhttps": ("TRANSPORT_FAILURE", "HTTP_503")}
    assert bytes(got["https://a.org/ok"]["content"]) == bodies["https://a.org/ok"] and got["https://a.org/busy"]["attempts"] == 3 and got["https://a.org/html"]["content"] is None


def test_lists_of_values(spark):
    told = {"A, B and C had d50 of 1, 2.5 and 3 um, respectively": [("A", 1.0), ("B", 2.5), ("C", 3.0)], "F1 and G2 were 1 um and 2 um, respectively": [("F1", 1.0), ("G2", 2.0)], "A, B, and C showed 1, 2, and -3 %, respectively": [("A", 1.0), ("B", 2.0), ("C", -3.0)], "A and B had 1, 2 and 3 um, respectively": [], "A and A had 1 and 2 um, respectively": [], "A and B had 1 and 2 um": []}
    got = {r["t"]: [(p["name"], p["value"]) for p in r["p"]] for r in spark.createDataFrame([(t,) for t in told], "t string").select("t", text.respective_pairs(F.col("t")).alias("p")).collect()}
    assert got == told


def test_frozen_orders(spark):
    got = matching.frozen_selection(spark.createDataFrame([(1, "c"), (2, "a"), (3, "c"), (4, "x"), (5, "d")], "place int, k string"), spark.createDataFrame([("a", 1), ("c", 3), ("d", 4), ("d", 5)], "k string, v int"), "k").orderBy("place").collect()
    assert [(r["k"], r["v"], r["status"]) for r in got] == [("c", 3, "FOUND"), ("a", 1, "FOUND"), ("c", None, "REPEATED"), ("x", None, "MISSING"), ("d", None, "REPEATED")]


def test_numbers_of_one_order_come_from_ranges(spark):
    from assaylake.operators import ranking
    from assaylake.plans import catalogue

    rows = spark.createDataFrame([(float(i % 7) if i % 11 else None, i) for i in range(500)], "v double, k int").repartition(5)
    got = ranking.numbered(rows, "place", F.desc("v"), F.col("k")).collect()
    told = sorted(got, key=lambda r: (r["v"] is None, -(r["v"] or 0), r["k"]))
    assert [r["place"] for r in told] == list(range(1, 501)) and ranking.numbered(rows.limit(0), "place", F.col("k")).isEmpty()
    plan = catalogue.QUERIES["frozen_order"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(o_totalprice" not in plan  # no window over all orders at once


def test_sampled_grams_meet_every_text(spark, monkeypatch):
    import random

    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("ab é日-") for _ in range(n))
    texts = [say(rng.randint(0, 400)) for _ in range(40)] + ["ab" * 300, "", None]
    quotes = []
    for t in [t for t in texts if t and len(t) > 100] * 3:
        a, n = rng.randint(0, len(t) - 60), rng.randint(1, 120)
        quotes.append(t[a : a + n])
    quotes += [say(60), "ab" * 40, " - ", None]
    q = spark.createDataFrame(list(enumerate(quotes)), "q int, t string")
    b = spark.createDataFrame(list(enumerate(texts)), "b int, t string")
    rows = lambda: sorted(map(tuple, matching.located_quotes(q, b, "q", "t", "b", "t").collect()))
    want = rows()
    monkeypatch.setattr(matching, "MAX_QUOTE_BYTES", 0)
    assert rows() == want and len(want) > len(quotes) // 2


def test_best_of_each_weight_sorts_no_table(spark):
    from assaylake.plans import catalogue

    plan = catalogue.QUERIES["weight_tuning"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 7 and "WindowGroupLimit" not in plan and "explode" not in plan


def test_sentences_are_matched_once_and_by_many_tasks(spark):
    from assaylake.plans import catalogue

    got = catalogue.QUERIES["respective_values"](spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan and plan.count("regexp_extract(") == 3 and plan.count("regexp_extract_all(") == 1


def test_unbound_formulations_do_not_gather_in_one_task(spark):
    from assaylake.operators import assembly

    points = spark.createDataFrame([("f", 1.0), ("f", 2.0), ("g", 1.0)], "figure string, x double")
    said = [("f", 1.0, "t", None, ["paste"], ["s"], ["(1%)"]), ("f", 2.0, "u", "r", ["paste"], ["s"], ["2"]), ("f", 2.0, None, "r", ["paste"], ["s"], ["2"])]
    assignments = spark.createDataFrame(said, "figure string, x double, test_id string, reference_id string, specimens array<string>, span_ids array<string>, tokens array<string>")
    mixes = spark.createDataFrame([("m", "t", "paste"), ("n", "r", "paste"), ("o", None, "paste")], "mix string, test_id string, specimen string")
    got = assembly.resolve_formulations(points, assignments, mixes, spark.createDataFrame([("s", "had (1%) or 2")], "span_id string, text string"))
    assert {(r["figure"], r["x"]): (r["test_id"], r["mix"], r["reference"], r["status"]) for r in got.collect()} == {("f", 1.0): ("t", "m", None, "RESOLVED"), ("f", 2.0): (None, None, "n", "AMBIGUOUS_AXIS_VALUE"), ("g", 1.0): (None, None, None, "NO_ASSIGNMENT")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all(re.search(rf"Join \[{test}#\d+, _only#\d+, _spare#\d+L\]", plan) for test in ("test_id", "reference_id"))


def test_controller_steps_are_folded_without_sorting_by_run(spark):
    from assaylake.operators import control

    runs = spark.createDataFrame([(k,) for k in range(6)], "run int")
    s = control.ARM_STEPS
    held = [(1, s[0], "a"), (2, s[0], "a"), (2, s[2], "c"), (3, s[0], "a"), (3, "what", "w"), (4, s[0], "a"), (4, s[1], "b"), (4, s[1], "b2"), (5, s[0], None)]
    steps = spark.createDataFrame(held, "run int, step string, artifact_sha256 string")
    now = spark.createDataFrame([(k, t, "b" if t == s[1] else a) for k, t, a in held], "run int, step string, artifact_sha256 string")
    got = control.controller_states(runs, steps, now)
    assert {r["run"]: (r["next_step"], r["error"]) for r in got.collect()} == {0: (s[0], None), 1: (s[1], None), 2: (None, "MISSING_STEP"), 3: (None, "UNKNOWN_STEP"), 4: (None, f"REPLAY_DIFFERS:{s[1]}"), 5: (s[1], None)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "bit_or" in plan


def test_cells_of_tables_are_dealt_by_number(spark):
    from assaylake.operators import cells

    captions = spark.createDataFrame([("d", 1, "Table 1"), ("d", 2, "Table 1"), ("e", 3, "Table 1"), ("f", 4, "Figure"), ("g", 5, "Table 1")], "document string, table_id int, caption string")
    grid = spark.createDataFrame([(t, c) for t in (1, 2, 3, 4) for c in ("a", "b", "b")] + [(5, "a"), (5, "a"), (5, "z")], "table_id int, text string")
    got = cells.one_table(captions, grid, "Table", spark.createDataFrame([("a",), ("b",), ("c",)], "label string"))
    assert {(r["document"], r["table_id"], r["status"]) for r in got.collect()} == {("d", 1, "AMBIGUOUS"), ("d", 2, "AMBIGUOUS"), ("e", 3, "SELECTED")}
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()


def test_plan_and_values_of_components_meet_in_one_shuffle(spark):
    from assaylake.operators import claims

    plan = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", 2), (1, "b", 1), (2, "a", None), (3, "a", 1)], "record int, component string, item int")
    values = spark.createDataFrame([(1, "a", 1, False), (1, "a", 1, True), (1, "a", 2, None), (2, "a", None, True), (3, "a", 1, True), (4, "a", 1, True)], "record int, component string, item int, validated boolean")
    got = claims.component_assessment(plan, values)
    told = got._jdf.queryExecution().executedPlan().toString()
    want = {(1, "a", 2, 2, 1, claims.PARTIAL), (1, "b", 1, 0, 0, claims.ABSENT), (2, "a", 1, 0, 0, claims.UNPLANNED), (3, "a", 1, 1, 1, claims.VALIDATED), (4, "a", 0, 0, 0, claims.UNPLANNED)}
    assert {tuple(r) for r in got.collect()} == want
    assert "FullOuter" not in told and told.count("Exchange hashpartitioning") == 1


def test_stable_anchors_shuffle_once_and_sort_no_text(spark):
    from assaylake.plans import catalogue

    plan = catalogue.QUERIES["stable_anchors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_tiers_of_pairs_run_once_and_are_not_broadcast(spark, monkeypatch):
    from assaylake.operators import review

    calls, write = [], review.written
    monkeypatch.setattr(review, "written", lambda df: (calls.append(1), write(df))[1])
    side = lambda rows: spark.createDataFrame(rows, "record int, left_id int, a string, b string")
    left, right = side([(1, 1, "x", "p"), (1, 2, "x", "q"), (1, 3, "y", "p"), (1, 4, None, "z"), (1, 5, "w", "v")]), side([(1, 1, "x", "p"), (1, 2, "y", "r"), (1, 3, "y", "s"), (1, 4, "u", "z"), (1, 5, "w", "v"), (1, 5, "w", "v")]).withColumnRenamed("left_id", "right_id")
    pairs, errors = review.paired_in_tiers(left, right, "record", [("BOTH", ["a", "b"], True), ("ONE", ["a"], True), ("LAST", ["b"], False)])
    plan = left.join(pairs, ["record", "left_id"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in pairs.collect()} == {(1, 1, 1, "BOTH"), (1, 5, 5, "BOTH"), (1, 4, 4, "LAST")}
    assert [tuple(r) for r in errors.collect()] == [(1, 3, "AMBIGUOUS_ONE")]
    assert len(calls) == 3 and "Broadcast" not in plan


def test_json_leaves_are_parsed_once_while_levels_are_written(spark):
    from assaylake.operators import claims

    rows = spark.createDataFrame([(1, '{"a": [1, {"b": null}, []], "c/d": "{x"}'), (2, " [ ]"), (3, None), (4, '{"a": }'), (5, "[[true]]")], "k int, t string")
    got = claims.flatten_json(rows, "k", "t")
    want = {("1", "/a/0", "1"), ("1", "/a/1/b", None), ("1", "/a/2", "[]"), ("1", "/c~1d", "{x"), ("2", "", " [ ]"), ("3", "", None), ("4", "", '{"a": }'), ("5", "/0/0", "true")}
    assert "json" not in got._jdf.queryExecution().executedPlan().toString().lower()
    assert {tuple(r) for r in got.collect()} == want
