"""Nested texts against Python's own JSON, and pointers against stepwise setting."""

import json
import random

import pyarrow as pa
import pytest

from assaylake.operators import json_trees

TEXTS = ['{"b":[1,2.5,{"x":null}],"a":{"0":"q\\"z","e":{},"f":[]}}', "5", "[]", "{}", "null", '"t"', '[[[[]]],[{"a":[null,{"/~":1}]}]]', "[1,[2,[3,[4,[5,[6,[7,[8,[9,[10,[11,[12]]]]]]]]]]]]", '{"10":1,"9":2,"é":{"":[]}}', '["a","b","c","d","e","f","g","h","i","j","k","l"]']


def made(rng, depth=0):
    kind = rng.random()
    if depth > 4 or kind < 0.4:
        return rng.choice([None, True, 1, -7, "x", "a/b", "~", "", 12345678901])
    if kind < 0.7:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["a", "b", "0", "1", "x/y", "~t", ""]): made(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def text_of(x):
    return json.dumps(x, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def test_round_trip(spark):
    rng = random.Random(0)
    texts = TEXTS + [json.dumps(made(rng)) for _ in range(150)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, "{broken"), (901, None)], "k int, t string")
    found = json_trees.leaves(rows, "k", "t")
    got = {int(r["record_key"]): r["json"] for r in json_trees.rebuilt(found).collect()}
    assert got == {i: text_of(json.loads(t)) for i, t in enumerate(texts)}
    claims = json_trees.nested_claims(rows, "k", "t", "docs")
    back = {int(r["record_key"]): r["json"] for r in json_trees.records_of(claims).collect()}
    assert back == got and claims.where("field_path = '/a/0'").first()["kinds"] is not None
    assert json_trees.rebuilt(json_trees.leaves(rows.limit(0), "k", "t")).count() == 0


def stepwise(text, edits):
    """The text after all edits, or None where one of them fails."""
    try:
        root = {} if text is None else json.loads(text)
        fresh = text is None
        edits = [([] if p in ("", "/") else [t.replace("~1", "/").replace("~0", "~") for t in p[1:].split("/")], json.loads(v)) for p, v in edits if p == "" or p.startswith("/") or 1 / 0]
        if len({tuple(p) for p, _ in edits}) < len(edits):
            return None
        is_place = lambda t: t.isascii() and t.isdigit() and len(t) < 10 and (t == "0" or t[0] != "0")
        for path, value in sorted(edits, key=lambda e: (len(e[0]), "/".join(e[0]))):
            if not path:
                root, fresh = value, False
                continue
            if fresh:
                root, fresh = ([] if is_place(path[0]) else {}), False
            at = root
            for k, token in enumerate(path):
                if isinstance(at, list):
                    if not is_place(token):
                        return None
                    token = int(token)
                    at.extend([None] * (token + 1 - len(at)))
                    there = at[token] is not None
                elif isinstance(at, dict):
                    there = token in at
                else:
                    return None
                if k == len(path) - 1:
                    at[token] = value
                else:
                    if not there:
                        at[token] = [] if is_place(path[k + 1]) else {}
                    at = at[token]
        return text_of(root)
    except (ValueError, ZeroDivisionError):
        return None


def test_set_pointers(spark):
    rng = random.Random(1)
    cases = []
    for _ in range(300):
        text = None if rng.random() < 0.2 else json.dumps(made(rng))
        edits = []
        for _ in range(rng.randint(0, 4)):
            path = "".join("/" + rng.choice(["a", "b", "0", "1", "3", "x~1y", "~0t", "01", ""]) for _ in range(rng.randint(0, 4)))
            edits.append((path, rng.choice(["1", "null", '"s"', "{}", "[]", '{"a":[1,{"b":2}]}', "[0,[1]]"] + ["{oops"] * (rng.random() < 0.1))))
        if rng.random() < 0.05:
            edits.append(("a/b", "1"))
        cases.append((text, edits))
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases) if t is not None], "k int, t string")
    asked = spark.createDataFrame([(i, p, v) for i, (_, e) in enumerate(cases) for p, v in e], "record_key long, pointer string, value string")
    got = {int(r["record_key"]): r for r in json_trees.set_pointers(rows, "k", "t", asked).collect()}
    want = {i: stepwise(t, e) for i, (t, e) in enumerate(cases) if t is not None or e}
    for i, w in want.items():
        assert got[i]["json"] == w and bool(got[i]["defects"]) == (w is None), (cases[i], w, got[i])
    assert set(got) == set(want) and 30 < sum(w is None for w in want.values()) < 250


@pytest.mark.parametrize("text,pointer,reason", [('{"a":1}', "/a/b", "scalar_parent /a"), ('{"a":null}', "/a/b", "scalar_parent /a"), ('{"a":[1]}', "/a/x", "list_token /a/x"), ("[1]", "/01", "list_token /01"), ("{}", "a", "not_a_pointer a")])
def test_defects(spark, text, pointer, reason):
    edit = spark.createDataFrame([("1", pointer, "2")], "record_key string, pointer string, value string")
    assert json_trees.set_pointers(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t", edit).first()["defects"] == [reason]


def test_leaves_fold_without_rows_for_their_nodes(spark):
    rows = [("r", ["a", "1", "b"], "oao", "2"), ("r", ["a", "0"], "oa", "1"), ("r", ["c"], "o", "{}"), ("r", ["c"], "o", "{}"), ("s", [], "", "null")]
    got = json_trees.rebuilt(spark.createDataFrame(rows, "record_key string, path array<string>, kinds string, json string"))
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert {r["record_key"]: r["json"] for r in got.collect()} == {"r": '{"a":[1,{"b":2}],"c":{}}', "s": "null"}


def test_records_are_edited_without_rows_for_their_nodes(spark):
    text = r'{"z": [1.50, 1e3, -0.0, 12345678901234567890123], "é\"\\": "\u0001\u001f\n\t/\u007f\ud83d\ude00", "b": [true, null, {}, []]}'
    rows = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "{oops")], "k int, t string")
    edits = spark.createDataFrame([("1", "/a", "2.50"), ("4", "/x", "1"), ("5", "", "[]")], "record_key string, pointer string, value string")
    met = json_trees.set_pointers(rows, "k", "t", edits)
    plan = met._jdf.queryExecution().executedPlan().toString()
    got = {r["record_key"]: r["json"] for r in met.collect()}
    assert got["1"].replace('"a":2.5,', "") == got["2"] and {k: got[k] for k in "345"} == {"3": None, "4": '{"x":1}', "5": "[]"}
    assert plan.count("Exchange") == 2 and "Generate" not in plan, plan


def test_leaves_are_folded_in_one_pass(spark):
    """No table is written, no job runs and no level has its own aggregate; gaps, odd names, records over several batches and conflicts fold as before."""
    rows = spark.createDataFrame([(i, json.dumps({"a": [{"b": i}] * 3})) for i in range(4)], "k int, t string")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    plan = json_trees.rebuilt(json_trees.leaves(rows, "k", "t"))._jdf.queryExecution().toString()
    assert len(tracker.getJobIdsForGroup()) == before and "Aggregate" not in plan, plan
    odd = [("g", ["2"], "a", '"x"'), ("g", ["0"], "a", "1"), ("c", ["a"], "o", "1"), ("c", ["a", "b"], "oo", "2"), ("c", ["a", "b"], "oo", "3"), ("n", [], "", "{}"), ("n", None, None, "7"), (None, ["1"], "o", "0"), ("w", ["x"], "a", "1"), ("w", ["+1"], "a", "1"), ("q", ['"\n'], "o", "1")]
    found = spark.createDataFrame(odd, "record_key string, path array<string>, kinds string, json string")
    want = [(None, '{"1":0}'), ("c", '{"a":{"b":3}}'), ("g", '[1,null,"x"]'), ("n", "7"), ("n", "{}"), ("q", '{"\\"\\n":1}'), ("w", "[null,1]")]
    assert sorted(map(tuple, json_trees.rebuilt(found).collect()), key=str) == sorted(want, key=str)


def test_records_go_on_over_batches(monkeypatch):
    rng = random.Random(3)
    texts = [text_of(made(rng)) for _ in range(200)]
    made_ = next(json_trees.leaf_batches([pa.RecordBatch.from_arrays([pa.array(map(str, range(200))), pa.array(texts)], names=["record_key", "text"])]))
    monkeypatch.setattr(json_trees, "LEAVES", 3)
    for n in (1, 2, 7, 1000):
        out = json_trees.record_batches(made_.slice(i, n) for i in range(0, made_.num_rows, n))
        assert [t for b in out for t in b.column("json").to_pylist()] == texts
