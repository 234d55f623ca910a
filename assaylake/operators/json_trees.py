"""Nested JSON texts as rows of leaves, and back: records are opened, edited by pointers and folded up again.

A text is opened in one narrow pass; a row holds one leaf, its path and the kinds of the containers above it. Leaves are
folded bottom-up: all rows of a record meet in one exchange, lie one after the other there, and are folded level by level
in Arrow batches of whole records. Pointers set values by rows as well: what lies below a set value falls away by an equi-join on
path prefixes, missing parents come from the path itself, and a pointer that cannot be followed is a defect of its record.

Texts are canonical: names sorted, no white space, numbers as the variant type prints them.

Defined cases: a null or broken text has no leaves; an empty container is a leaf; a null stays a leaf `null`; an index beyond
the end of an array fills it up with nulls; an array index is plain digits without leading zeros, nine at most; a
record that only edits name begins empty. Rows that repeat a record key are one record if they hold the same leaves.
"""

from __future__ import annotations

import gc
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.json_paths import unescape_token
from assaylake.plans.storage import dealt

NOWHERE = -1
NO_PLACE = 1 << 40
#: Names of paths in an Arrow batch of leaves, and leaves that are folded at once; a text or record goes beyond them as a whole.
NAMES, LEAVES = 1 << 15, 1 << 16
#: What Spark casts to an int.
INDEX = re.compile(r"[\x00-\x20\x7f]*([+-]?[0-9]+)[\x00-\x20\x7f]*")


def canonical_text(text: Column) -> Column:
    return F.to_json(F.try_parse_json(text))


def tokens(pointer: Column, slash_is_whole: bool = False) -> Column:
    """The names of a pointer; the whole document is the empty pointer, and `/` (else the empty name) where asked for."""
    parts = F.slice(F.split(pointer, "/", -1), 2, F.lit(1 << 30))
    return F.when(pointer.isin("", "/") if slash_is_whole else pointer == "", F.array().cast("array<string>")).otherwise(F.transform(parts, unescape_token))


def leaves(rows: DataFrame, key: str, text: str) -> DataFrame:
    """record_key, path, kinds (`o` or `a` for each container above), json: the leaves of all texts."""
    texts = rows.select(F.col(key).cast("string").alias("record_key"), canonical_text(F.col(text)).alias("text"))
    return texts.where("text IS NOT NULL").mapInArrow(leaf_batches, "record_key string, path array<string>, kinds string, json string")


def leaf_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gc.disable()  # parsed texts have no cycles, and there are as many small containers as leaves
    try:
        for batch in batches:
            keys, texts = batch.column("record_key"), batch.column("text").to_pylist()
            at, ends, names, kinds, values = [], [0], [], [], []
            for i, text in enumerate(texts):
                before = len(values)
                add_leaves(parsed(text), names, ends, kinds, values)
                at += [i] * (len(values) - before)
                if len(names) > NAMES or i == len(texts) - 1:
                    paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names, pa.string()))
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int32())), paths, pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["record_key", "path", "kinds", "json"])
                    at, ends, names, kinds, values = [], [0], [], [], []
    finally:
        gc.enable()


def add_leaves(value: object, names: list[str], ends: list[int], kinds: list[str], values: list[str]) -> None:
    """Adds the leaves of a value: the names of their paths, where these end, their kinds and texts."""
    todo = [([], "", value)] if isinstance(value, (dict, list)) and value else []
    if not todo:
        ends.append(len(names))
        kinds.append("")
        values.append(leaf_text(value))
    while todo:
        path, above, v = todo.pop()
        kind = above + ("o" if isinstance(v, dict) else "a")
        for name, x in v.items() if isinstance(v, dict) else zip(map(str, range(len(v))), v):
            if isinstance(x, (dict, list)) and x:
                todo.append(([*path, name], kind, x))
            else:
                names += path
                names.append(name)
                ends.append(len(names))
                kinds.append(kind)
                values.append(leaf_text(x))


def rebuilt(found: DataFrame) -> DataFrame:
    """record_key, json: the canonical texts of records given as `leaves`, exactly."""
    by_record = dealt(found.select("record_key", "path", "kinds", "json"), "record_key").sortWithinPartitions("record_key")
    return by_record.mapInArrow(record_batches, "record_key string, json string")


def record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of records whose leaves lie one after the other; a record that a batch may not end waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if sum(b.num_rows for b in waiting) + batch.num_rows > LEAVES:
            last = np.flatnonzero(np.diff(codes_of(batch.column("record_key"))))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut or (waiting and waiting[-1].column("record_key")[-1].as_py() != batch.column("record_key")[0].as_py()):
                yield folded([*waiting, batch.slice(0, cut)])
                waiting, batch = [], batch.slice(cut)
        waiting.append(batch)
    if waiting:
        yield folded(waiting)


def codes_of(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def folded(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Whole records, their leaves one after the other, folded level by level for all of them at once; leaves without a path give a row of their own."""
    key, path, kinds, json_ = [pa.concat_arrays([b.column(c) for b in batches]) for c in ("record_key", "path", "kinds", "json")]
    codes = codes_of(key)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
    record = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    depth = pc.fill_null(pc.list_value_length(path), NOWHERE).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(np.maximum(depth, 0))])[:-1]
    token, names = ranked(path.flatten())
    # Down: nodes of a level are numbered by parent and name.
    node, levels = record.copy(), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k in range(1, int(depth.max()) + 1):
        deep = np.flatnonzero(depth >= k)
        pairs, node[deep] = np.unique(node[deep] * len(names) + token[at[deep] + k - 1], return_inverse=True)
        levels.append((pairs // len(names), pairs % len(names)))
    # Up: each level's texts from its own leaves and from the level below it.
    begin, place = pa.array([*(f"{'null' if n is None else quoted(n)}:" for n in names), ""], pa.string()), np.array([*map(place_of, names), 0], np.int64)
    texts, below, words = None, None, []
    for k in range(len(levels) - 1, -1, -1):
        rows = np.flatnonzero(depth == k)
        n = len(starts) if k == 0 else len(levels[k][0])
        own_text, own_kinds = (largest(column.take(pa.array(rows)), node[rows], n) for column in (json_, kinds))
        some = np.bincount(node[rows], minlength=n) > 0
        if texts is not None:
            parent, name = levels[k + 1]
            heads = np.flatnonzero(np.diff(parent, prepend=NOWHERE))  # members lie by parent
            holders, told = parent[heads], np.maximum.reduceat(below, heads)
            listed = np.zeros(n, bool)
            listed[holders] = np.array([w[k : k + 1] == "a" for w in words] + [False])[told]  # a container's kind is told by what lies in it
            made = joined(texts, parent, name, listed, begin, place, n)
            is_holder = np.isin(np.arange(n), holders)
            own_text = pc.if_else(pa.array(is_holder), made, own_text)
            above = np.full(n, NOWHERE)
            above[holders] = told
            inherited = pa.array([w[:k] for w in words] + [None], pa.string()).take(pa.array(np.where(above < 0, len(words), above)))
            own_kinds, some = pc.coalesce(inherited, own_kinds), some | is_holder
        texts = own_text
        below, words = ranked(own_kinds)
        below = np.where(np.array([w is None for w in words], bool)[below], NOWHERE, below) if len(words) else below
    keep, pathless = pa.array(np.flatnonzero(some)), np.flatnonzero(depth == NOWHERE)
    heads = key.take(pa.array(starts))
    out_key, out_text = heads.take(keep), texts.take(keep)
    if len(pathless):
        lone, its = np.unique(record[pathless], return_inverse=True)
        out_key = pa.concat_arrays([out_key, heads.take(pa.array(lone))])
        out_text = pa.concat_arrays([out_text, largest(json_.take(pa.array(pathless)), its, len(lone))])
    return pa.RecordBatch.from_arrays([out_key, out_text], names=["record_key", "json"])


def ranked(texts: pa.Array) -> tuple[np.ndarray, list[str | None]]:
    """Each text's place among the different ones in order (none first), and these."""
    found = texts.dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(found.dictionary, null_placement="at_start")
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return rank[found.indices.to_numpy(zero_copy_only=False)], found.dictionary.take(order).to_pylist()


def largest(texts: pa.Array, group: np.ndarray, n: int) -> pa.Array:
    """The largest text of each of n groups, or null."""
    if len(np.unique(group)) < len(group):
        rows = pa.table({"group": group, "text": texts})
        order = pc.sort_indices(rows, [("group", "ascending"), ("text", "ascending")], null_placement="at_start").to_numpy()
        order = order[np.append(np.diff(group[order]) != 0, True)]
        texts, group = texts.take(pa.array(order)), group[order]
    source = np.full(n, NOWHERE)
    source[group] = np.arange(len(group))
    return texts.take(pa.array(source, mask=source < 0))


def joined(texts: pa.Array, parent: np.ndarray, name: np.ndarray, listed: np.ndarray, begin: pa.Array, place: np.ndarray, n: int) -> pa.Array:
    """The text of each of n containers (`listed`: arrays) from its members, which lie by parent and name; a member without a text, or in an array without a place, is left out."""
    in_list = listed[parent]
    kept = texts.is_valid().to_numpy(zero_copy_only=False) & ~(in_list & (place[name] == NO_PLACE))
    order = np.flatnonzero(kept)
    if in_list.any():
        spot = np.where(in_list, place[name], name)[order]
        order = order[np.lexsort((spot, parent[order]))]
        p, spot = parent[order], np.where(in_list, place[name], name)[order]
        if ((np.diff(p) == 0) & (np.diff(spot) == 0)).any():  # 1 and 01
            order = order[pc.sort_indices(pa.table({"p": p, "s": spot, "t": texts.take(pa.array(order))}), [("p", "ascending"), ("s", "ascending"), ("t", "ascending")]).to_numpy()]
    p, inside, spot = parent[order], in_list[order], place[name[order]]
    prefix = begin.take(pa.array(np.where(inside, len(begin) - 1, name[order])))
    gap = np.where(inside, spot - np.where(np.diff(p, prepend=NOWHERE) == 0, np.roll(spot, 1), NOWHERE) - 1, 0)
    if (gap > 0).any():
        prefix = pc.if_else(pa.array(gap > 0), pc.binary_repeat("null,", pa.array(np.maximum(gap, 0))), prefix)
    pieces = pc.binary_join_element_wise(prefix, texts.take(pa.array(order)), "")
    ends = np.concatenate([[0], np.cumsum(np.bincount(p, minlength=n))])
    inner = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), ",")
    marks = [pa.array([o, a], pa.string()).take(pa.array(listed.astype(np.int64))) for o, a in ("{[", "}]")]
    return pc.binary_join_element_wise(marks[0], inner, marks[1], "")


def place_of(name: str | None) -> int:
    """A name as Spark casts it to an int, or NO_PLACE."""
    found = INDEX.fullmatch(name or "")
    place = int(found[1]) if found else NO_PLACE
    return place if -(1 << 31) <= place < 1 << 31 else NO_PLACE


def nested_claims(rows: DataFrame, key: str, text: str, collection: str) -> DataFrame:
    """(collection, record_key, field_path, value, kinds): one claim for each leaf; `kinds` tells objects with numbers for names from arrays."""
    return leaves(rows, key, text).select(F.lit(collection).alias("collection"), "record_key", pointer_of("path").alias("field_path"), F.col("json").alias("value"), "kinds")


def records_of(claims: DataFrame) -> DataFrame:
    """collection, record_key, json: the records of `nested_claims`."""
    one = claims.select(F.to_json(F.struct("collection", "record_key")).alias("record_key"), tokens(F.col("field_path")).alias("path"), "kinds", F.col("value").alias("json"))
    return rebuilt(one).select(F.get_json_object("record_key", "$.collection").alias("collection"), F.get_json_object("record_key", "$.record_key").alias("record_key"), "json")


def pointer_of(path: str) -> Column:
    return F.array_join(F.transform(path, lambda t: F.concat(F.lit("/"), F.replace(F.replace(t, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))), "")


PLACE = "^(0|[1-9][0-9]{0,8})$"


def set_pointers(rows: DataFrame, key: str, text: str, edits: DataFrame) -> DataFrame:
    """record_key, json, defects: texts after `edits` (record_key, pointer, value as JSON text), shorter pointers first; `/` is the whole text.

    What a set value replaces is gone; missing parents are made, as an array where the next name of the first pointer through them is an index.
    json is null where a record has defects (reason and place, in order): not_a_pointer, broken_value, repeated_pointer (one place twice), scalar_parent (a
    pointer goes through a value, or through a null in an object), list_token (an array meets a name that is no index).
    Texts and edits are grouped by record, one row each, and meet in one equi-join; a record is edited within its row.
    """
    asked = edits.select(F.col("record_key").cast("string").alias("record_key"), F.struct("pointer", tokens(F.col("pointer"), slash_is_whole=True).alias("path"), canonical_text(F.col("value")).alias("value")).alias("edit"))
    source = rows.select(F.col(key).cast("string").alias("_k"), F.struct(canonical_text(F.col(text)).alias("json")).alias("text"))
    texts = source.groupBy("_k").agg(F.collect_list("text").alias("texts"))
    edited = asked.groupBy("record_key").agg(F.collect_list("edit").alias("edits"))
    met = texts.join(edited, texts["_k"] == edited["record_key"], "full").select(F.coalesce("_k", "record_key").alias("record_key"), "texts", "edits")
    return met.mapInArrow(edit_batches, "record_key string, json string, defects array<string>")


def edit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_key", pa.string()), ("json", pa.string()), ("defects", pa.list_(pa.string()))])
    for batch in batches:
        out: list[tuple[str | None, str | None, list[str]]] = []
        for key, texts, edits in zip(*[batch.column(c).to_pylist() for c in ("record_key", "texts", "edits")], strict=True):
            given = [t["json"] for t in texts or []]
            if edits is None:
                out += [(key, t, []) for t in given]
            else:
                out.append((key, *edited_text(max((t for t in given if t is not None), default=None), [(e["pointer"], None if e["path"] is None else tuple(e["path"]), e["value"]) for e in edits])))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)


class Number(str):
    """A number as it is printed."""


DECODER = json.JSONDecoder(parse_int=Number, parse_float=Number, strict=False)


def parsed(text: str) -> object:
    return DECODER.decode(text)


#: What a canonical text escapes.
ESCAPES = {i: f"\\u{i:04X}" for i in range(32)} | {ord(c): f"\\{e}" for c, e in zip('"\\\b\f\n\r\t', '"\\bfnrt', strict=True)}
ESCAPED = re.compile(r'[\x00-\x1f"\\]')


def quoted(text: str) -> str:
    return f'"{text.translate(ESCAPES)}"' if ESCAPED.search(text) else f'"{text}"'


def leaf_text(v: object) -> str:
    if isinstance(v, Number):
        return v
    return quoted(v) if isinstance(v, str) else {None: "null", True: "true", False: "false"}[v] if v is None or isinstance(v, bool) else "{}" if isinstance(v, dict) else "[]"


class Node:
    """A place of a record: `through` is the first pointer that passes it (names, pointer, next name)."""

    __slots__ = ("kids", "kind", "text", "through")

    def __init__(self) -> None:
        self.kind: str | None = None
        self.text: str | None = None
        self.through: tuple[int, str, str] | None = None
        self.kids: dict[str, Node] = {}

    def at(self, path: tuple[str, ...]) -> Node:
        node = self
        for name in path:
            node = node.kids.setdefault(name, Node())
        return node


def edited_text(text: str | None, edits: list[tuple[str | None, tuple[str, ...] | None, str | None]]) -> tuple[str | None, list[str]]:
    """A record's canonical text (or none) after edits (pointer, its names, canonical value), and its defects: see `set_pointers`."""
    root, count = Node(), Counter(path for _, path, _ in edits if path is not None)
    defects = {f"repeated_pointer {pointer_text(path)}" for path, n in count.items() if n > 1}
    defects |= {f"broken_value {pointer}" for pointer, _, value in edits if value is None and pointer is not None}
    sound = []
    for pointer, path, value in edits:
        if pointer is None or (pointer != "" and not pointer.startswith("/")):
            defects.add(f"not_a_pointer {pointer or ''}")
        elif value is not None:
            sound.append((path, value))
    trees = [((), -1, text)] if text is not None else []
    for path, start, given in trees + [(path, len(path), value) for path, value in sound]:
        grow(root, path, start, parsed(given), count)
    for path, _ in sound:
        for j, name in enumerate(path):
            node, passing = root.at(path[:j]), (len(path), "/".join(path), name)
            node.through = passing if node.through is None else min(node.through, passing)
    nodes = walk(root)
    defects |= {d for parent, node, path in nodes if (d := defect(parent, node, path))}
    return (None, sorted(defects)) if defects else (folded_text(nodes), [])


def grow(root: Node, path: tuple[str, ...], start: int, value: object, pointers: Counter) -> None:
    """Puts a value's nodes in their places, but for those that a pointer of more than `start` names replaces."""
    todo = [(path, value)]
    while todo:
        path, v = todo.pop()
        if len(path) > start and path in pointers:
            continue
        node = root.at(path)
        if isinstance(v, (dict, list)) and v:
            node.kind = max(node.kind or "", "o" if isinstance(v, dict) else "a")
            todo += [((*path, k), x) for k, x in (v.items() if isinstance(v, dict) else ((str(i), x) for i, x in enumerate(v)))]
        else:
            node.text = max(node.text or "", leaf_text(v))


def walk(root: Node) -> list[tuple[Node | None, Node, tuple[str, ...]]]:
    """(parent, node, path), parents first; containers that pointers make are given their kind."""
    found: list[tuple[Node | None, Node, tuple[str, ...]]] = [(None, root, ())]
    for _, node, path in found:
        if node.kind is None and node.through is not None:
            node.kind = {"{}": "o", "[]": "a"}.get(node.text or "") or ("a" if is_place(node.through[2]) else "o")
        found += [(node, kid, (*path, name)) for name, kid in node.kids.items()]
    return found


def is_place(name: str) -> bool:
    return re.fullmatch(PLACE, name) is not None


def defect(parent: Node | None, node: Node, path: tuple[str, ...]) -> str | None:
    """Why pointers cannot pass or reach a node."""
    in_list = parent is not None and parent.kind == "a"
    if node.through is not None and not (node.text in (None, "{}", "[]") or (node.text == "null" and in_list)):
        return f"scalar_parent {pointer_text(path)}"
    return f"list_token {pointer_text(path)}" if in_list and not is_place(path[-1]) else None


def pointer_text(path: tuple[str, ...]) -> str:
    return "".join("/" + name.replace("~", "~0").replace("/", "~1") for name in path)


def folded_text(nodes: list[tuple[Node | None, Node, tuple[str, ...]]]) -> str:
    """The text of a record's root: its nodes folded from the last to the first."""
    for _, node, _ in reversed(nodes):
        if node.kids and node.kind == "a":
            parts, before = [], NOWHERE
            for place, kid in sorted(((int(name), kid) for name, kid in node.kids.items()), key=lambda e: e[0]):
                parts += ["null"] * (place - before - 1) + [kid.text]
                before = place
            node.text = f"[{','.join(parts)}]"
        elif node.kids:
            node.text = "{" + ",".join(f"{quoted(name)}:{node.kids[name].text}" for name in sorted(node.kids)) + "}"
    return nodes[0][1].text
