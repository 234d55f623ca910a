"""Tiered, nearest and tolerance joins. Each reduces its candidates per left row; none builds all pairs without a key."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def either_key(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], value: str) -> DataFrame:
    """`left` with `value` of the right row found by the first key that finds one: one equi-join a key, never an OR condition."""
    out, found = left, []
    for i, (lk, rk) in enumerate(keys):
        side = right.where(F.col(rk).isNotNull()).groupBy(F.col(rk).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(side, F.col(lk) == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    return out.select(*left.columns, F.coalesce(*found).alias(value), F.coalesce(*[F.when(v.isNotNull(), F.lit(lk)) for v, (lk, _) in zip(found, keys, strict=True)]).alias("matched_by"))


def frozen_selection(selected: DataFrame, catalog: DataFrame, key: str, place: str = "place") -> DataFrame:
    """(place, key, catalog's other columns, status): catalog rows of the selected keys in their frozen order, one row a place: FOUND, MISSING, or REPEATED where the key has a place before or several rows.

    The order is the place that was frozen with the selection, never that of the catalog; a repeated key shows nothing of the catalog.
    """
    others = [c for c in catalog.columns if c != key]
    one = catalog.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_row"))
    again = F.row_number().over(Window.partitionBy(key).orderBy(place)) > 1
    met = selected.select(place, key).withColumn("_again", again).join(one, key, "left")
    status = F.when(F.col("_n").isNull(), "MISSING").when(F.col("_again") | (F.col("_n") > 1), "REPEATED").otherwise("FOUND")
    told = met.withColumn("status", status)
    return told.select(place, key, *[F.when(F.col("status") == "FOUND", F.col(f"_row.{c}")).alias(c) for c in others], "status")


def longest_prefix(paths: DataFrame, prefixes: DataFrame, path: str, prefix: str, separator: str = "/") -> DataFrame:
    """`paths` with the longest prefix, in whole steps, that `prefixes` holds: an equi-join on each path's own prefixes, not a range join."""
    parts = F.split(F.col(path), separator)
    own = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))
    cut = paths.select(path).distinct().select(path, F.explode(own).alias("_p"))
    held = prefixes.select(F.col(prefix).alias("_p")).distinct()
    best = cut.join(held, "_p").groupBy(path).agg(F.max_by("_p", F.length("_p")).alias("prefix"))
    return paths.join(best, path, "left")


def _nearest_of_key(targets: DataFrame, anchors: DataFrame, scope: str, target: str, anchor: str, key: str, at: str | None) -> DataFrame:
    """(scope, target, _at, _a, _d): of the anchors with the target's scope and key the nearest one; ties go to the smaller place, then the smaller anchor. An anchor without a place comes first."""
    place = lambda: F.col(at) if at else F.lit(0)
    own = anchors.where(F.col(scope).isNotNull() & F.col(key).isNotNull()).groupBy(scope, F.col(key).alias("_k"), place().alias("_at")).agg(F.min(anchor).alias("_a"))
    asked = targets.where(F.col(scope).isNotNull() & F.col(key).isNotNull()).select(scope, F.col(key).alias("_k"), place().alias("_at"), F.col(target).alias("_t"), F.lit(True).alias("_asked"))
    rows = asked.unionByName(own.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    order = Window.partitionBy(scope, "_k").orderBy("_at", "_asked")
    turned = Window.partitionBy(scope, "_k").orderBy(F.col("_at").desc(), F.col("_asked").desc())
    held = F.when(~F.col("_asked") & F.col("_at").isNotNull(), F.struct("_at", "_a"))
    lost = F.when(~F.col("_asked") & F.col("_at").isNull(), F.struct("_at", "_a"))
    rows = rows.withColumns({
        "_b": F.last(held, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "_f": F.last(held, ignorenulls=True).over(turned.rowsBetween(Window.unboundedPreceding, 0)),
        "_n": F.first(lost, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    }).where("_asked")
    nearer = F.when(F.col("_b").isNull(), F.col("_f")).when(F.col("_f").isNull() | (F.col("_at") - F.col("_b._at") <= F.col("_f._at") - F.col("_at")), F.col("_b")).otherwise(F.col("_f"))
    best = rows.withColumn("_best", F.coalesce("_n", nearer)).where("_best IS NOT NULL")
    return best.select(scope, F.col("_t").alias(target), F.col("_best._at").alias("_at"), F.col("_best._a").alias("_a"), F.abs(F.col("_at") - F.col("_best._at")).alias("_d"))


def nearest_anchor(targets: DataFrame, anchors: DataFrame, scope: str, target: str, anchor: str, keys: list[str], row: tuple[str, str] | None = None) -> DataFrame:
    """(scope, target, anchor, tier): anchors ranked by the first key of `keys` on which both agree, then by distance row, column, anchor.

    `row` names the row and column numbers on both sides; equal names on both sides are expected. With one
    number or none, each tier is an ordered scan of both sides, as in `nearest_before_and_after`; with two, no
    order of rows tells the nearest, and a tier is an equi-join on scope and key of the targets that no tier before has placed.
    """
    order = lambda: Window.partitionBy(scope, target).orderBy("tier", "_d", *[f"_{c}" for c in row or ()], "_a")
    if len(row or ()) < 2:
        found = [_nearest_of_key(targets, anchors, scope, target, anchor, k, row[0] if row else None).withColumn("tier", F.lit(i + 1)) for i, k in enumerate(keys)]
        met = functools.reduce(DataFrame.unionByName, found)
        if row:
            met = met.withColumnRenamed("_at", f"_{row[0]}")
        return met.withColumn("_r", F.row_number().over(order())).where("_r = 1").select(scope, target, F.col("_a").alias("anchor"), "tier", F.col("_d").alias("distance"))
    places = list(row)
    distance = sum((F.abs(F.col(c) - F.col(f"_{c}")) for c in places), F.lit(0))
    best, left = None, targets
    for i, key in enumerate(keys):
        a = anchors.where(F.col(key).isNotNull()).select(scope, F.col(anchor).alias("_a"), F.col(key), *[F.col(c).alias(f"_{c}") for c in places])
        met = left.join(a, [scope, key]).withColumn("tier", F.lit(i + 1)).withColumn("_d", distance)
        found = met.withColumn("_r", F.row_number().over(order())).where("_r = 1").select(scope, target, F.col("_a").alias("anchor"), "tier", F.col("_d").alias("distance"))
        best = found if best is None else best.unionByName(found)
        left = left.join(found.select(scope, target), [scope, target], "left_anti")
    return best


def nearest_before_and_after(left: DataFrame, right: DataFrame, scope: str, at: str, name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """`left` with the nearest right position of its scope; ties go to the smaller one.

    Both sides are merged and scanned in order and backwards (last seen each time), so the work is two sorts, not a product: a frame that
    begins at the row itself would be read anew to its end for each row.
    """
    marked = left.withColumn("_right", F.lit(None).cast(left.schema[at].dataType)).unionByName(right.select(scope, F.col(at), F.col(at).alias("_right")), allowMissingColumns=True)
    order = Window.partitionBy(scope).orderBy(at, F.col("_right").isNull(), *ties)
    back = F.last("_right", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    turned = Window.partitionBy(scope).orderBy(F.col(at).desc(), F.col("_right").isNull().desc(), *[F.col(c).desc() for c in ties])
    ahead = F.last("_right", ignorenulls=True).over(turned.rowsBetween(Window.unboundedPreceding, 0))
    rows = marked.withColumns({"_b": back, "_f": ahead, "_is_right": F.col("_right").isNotNull()}).where("NOT _is_right")
    near = F.when(F.col("_b").isNull(), F.col("_f")).when(F.col("_f").isNull(), F.col("_b")).when(F.col(at) - F.col("_b") <= F.col("_f") - F.col(at), F.col("_b")).otherwise(F.col("_f"))
    return rows.withColumn(name, near).drop("_right", "_b", "_f", "_is_right")


def closest_claims(assigned: DataFrame, target: str, distance: Column, *ties: str) -> DataFrame:
    """Of the rows that claim a target the closest one."""
    order = Window.partitionBy(target).orderBy(distance, *ties)
    return assigned.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def tiered_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, str]]) -> DataFrame:
    """(left, right, tier): each tier pairs what is left over where a key names exactly one row on both sides."""
    parts = None
    free_l, free_r = left, right
    for i, (lk, rk) in enumerate(tiers):
        one_l = free_l.where(F.col(lk).isNotNull()).groupBy(F.col(lk).alias("_k")).agg(F.min(left_id).alias("left_id"), F.count(F.lit(1)).alias("_nl")).where("_nl = 1")
        one_r = free_r.where(F.col(rk).isNotNull()).groupBy(F.col(rk).alias("_k")).agg(F.min(right_id).alias("right_id"), F.count(F.lit(1)).alias("_nr")).where("_nr = 1")
        found = one_l.join(one_r, "_k").select("left_id", "right_id", F.lit(i + 1).alias("tier"))
        parts = found if parts is None else parts.unionByName(found)
        free_l = free_l.join(found, free_l[left_id] == found["left_id"], "left_anti")
        free_r = free_r.join(found, free_r[right_id] == found["right_id"], "left_anti")
    return parts


def tolerance_pairs(left: DataFrame, right: DataFrame, keys: list[str], value: str, tolerance: float, left_id: str, right_id: str) -> DataFrame:
    """(left, right) with equal keys and values within the tolerance: both sides are binned, each left row meets its bin and the two beside it."""
    width = F.lit(max(tolerance, 1e-9) * 2)
    a = left.withColumn("_bin", F.explode(F.array(*[F.floor(F.col(value) / width) + d for d in (-1, 0, 1)])))
    b = right.select(*keys, F.col(value).alias("_v"), F.col(right_id).alias("_rid")).withColumn("_bin", F.floor(F.col("_v") / width))
    met = a.join(b, [*keys, "_bin"]).where(F.abs(F.col(value) - F.col("_v")) <= tolerance)
    return met.select(F.col(left_id).alias("left_id"), F.col("_rid").alias("right_id"))


def multiset_compare(left: DataFrame, right: DataFrame, left_id: str, right_id: str, exact: list[str], loose: list[str]) -> DataFrame:
    """(left_id, right_id, outcome): exact, equivalent, missing_right or missing_left; each row is used once.

    Rows are numbered within their key on both sides and joined on key and number, first by all columns of `exact`, then by those of `loose`.
    """

    def numbered(rows: DataFrame, keys: list[str], row_id: str, name: str) -> DataFrame:
        key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
        rows = rows.withColumn("_key", key)
        return rows.select(F.col(row_id).alias(name), "_key", F.row_number().over(Window.partitionBy("_key").orderBy(row_id)).alias("_n"))

    first = numbered(left, exact, left_id, "left_id").join(numbered(right, exact, right_id, "right_id"), ["_key", "_n"])
    pairs = first.select("left_id", "right_id", F.lit("exact").alias("outcome"))
    rest_l = left.join(pairs, left[left_id] == pairs["left_id"], "left_anti")
    rest_r = right.join(pairs, right[right_id] == pairs["right_id"], "left_anti")
    second = numbered(rest_l, loose, left_id, "left_id").join(numbered(rest_r, loose, right_id, "right_id"), ["_key", "_n"], "full")
    outcome = F.when(F.col("right_id").isNull(), "missing_right").when(F.col("left_id").isNull(), "missing_left").otherwise("equivalent")
    return pairs.unionByName(second.select("left_id", "right_id", outcome.alias("outcome")))


def unanimous_context(rows: DataFrame, owner: str, context: list[str]) -> DataFrame:
    """(owner, n_rows, context columns): the context where all rows of an owner agree, null columns where they don't."""
    got = rows.groupBy(owner).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct(*context)).alias("_n"), F.min(F.struct(*context)).alias("_c"))
    return got.select(owner, "n_rows", *[F.when(F.col("_n") == 1, F.col("_c")[c]).alias(c) for c in context], (F.col("_n") == 1).alias("unanimous"))


def supported(derived: DataFrame, direct: DataFrame, owner: str, value: str, derived_value: str, tolerance: Column) -> DataFrame:
    """`derived` with the direct value of its owner and whether the difference is within the tolerance."""
    d = direct.select(owner, F.col(value))
    met = derived.join(d, owner, "left")
    return met.withColumn("difference", F.abs(F.col(derived_value) - F.col(value))).withColumn("supports", F.coalesce(F.col("difference") <= tolerance, F.lit(False)))


def boxes_holding(tokens: DataFrame, boxes: DataFrame, page: str = "page", cell: float = 64.0) -> DataFrame:
    """Token rows with the boxes that hold their centre: a grid turns the containment into an equi-join on page and cell.

    tokens: page, token_id, x, y; boxes: page, box_id, x0, y0, x1, y1.
    """
    grid = boxes.withColumn("_cx", F.explode(F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell)))).withColumn("_cy", F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))))
    placed = tokens.withColumns({"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)})
    return placed.join(grid, [page, "_cx", "_cy"]).where("x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1").drop("_cx", "_cy")


#: Bytes of quotes that are broadcast as one automaton; beyond, grams of both sides meet in an equi-join.
MAX_QUOTE_BYTES = 32 << 20
GRAM, STEP = 24, 16


def located_quotes(quotes: DataFrame, blocks: DataFrame, quote_id: str, quote: str, block_id: str, text: str) -> DataFrame:
    """(quote_id, block_id, tier, position): the first place of a quote in each text; tier 1 literally, tier 2 without white space and hyphens."""
    plain = lambda c: F.regexp_replace(F.lower(c), r"[\s\-]+", "")
    q = quotes.select(F.col(quote_id).alias("q"), F.col(quote).alias("quote"), plain(quote).alias("pq")).where("length(pq) > 0")
    b = blocks.select(F.col(block_id).alias("b"), F.col(text).alias("text"), plain(text).alias("pb"))
    size = q.agg(F.coalesce(F.sum(F.octet_length("quote") + F.octet_length("pq")), F.lit(0)).alias("n")).first()["n"]
    found = _by_automaton(q, b) if size <= MAX_QUOTE_BYTES else _by_grams(q, b)
    return found.select(F.col("q").alias(quote_id), F.col("b").alias(block_id), F.when(F.col("at") > 0, 1).otherwise(2).alias("tier"), F.when(F.col("at") > 0, F.col("at")).otherwise(F.col("loose")).alias("position"))


def _by_automaton(q: DataFrame, b: DataFrame) -> DataFrame:
    shared = q.sparkSession.sparkContext.broadcast([tuple(r) for r in q.collect()])  # MAX_QUOTE_BYTES at most
    id_type = to_arrow_type(q.schema["q"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine, by_plain = ahocorasick.Automaton(), {}
        for place, (_, _, plain) in enumerate(shared.value):
            by_plain.setdefault(plain, []).append(place)
        for plain, places in by_plain.items():
            machine.add_word(plain, (len(plain), places))
        if by_plain:
            machine.make_automaton()
        for batch in batches:
            rows = []
            for i, (text, plain) in enumerate(zip(batch.column("text").to_pylist(), batch.column("pb").to_pylist(), strict=True)):
                first: dict[int, int] = {}
                for end, (n, places) in machine.iter(plain) if by_plain and plain else ():
                    for place in places:
                        first.setdefault(place, end - n + 2)
                rows += [(i, place, text.find(shared.value[place][1]) + 1, at) for place, at in first.items()]
            if rows:
                i, place, at, loose = zip(*rows, strict=True)
                ids = pa.array([shared.value[x][0] for x in place], id_type)
                yield pa.RecordBatch.from_arrays([ids, batch.column("b").take(pa.array(i)), pa.array(at, pa.int64()), pa.array(loose, pa.int64())], names=["q", "b", "at", "loose"])

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((q, "q"), (b, "b"))]
    return b.mapInArrow(run, ", ".join([*kinds, "at long", "loose long"]))


def _by_grams(q: DataFrame, b: DataFrame) -> DataFrame:
    """Quotes of GRAM + STEP - 1 characters or more meet texts by sampled grams, shorter ones by the grams of their own length; what meets is verified on the whole texts."""
    long_ = F.length("pq") >= GRAM + STEP - 1
    met = sampled_grams(q.where(long_).select(F.col("q").alias("id"), F.substr("pq", F.lit(1), F.lit(GRAM + STEP - 1)).alias("text")), "q").join(sampled_grams(b.select(F.col("b").alias("id"), F.col("pb").alias("text")), "b"), "gram").select("b", "q").distinct()
    found = met.join(q, "q")
    short = q.where(~long_).withColumn("gram", F.substr(F.col("pq"), F.lit(1), F.lit(GRAM)))
    for row in short.select(F.length("gram").alias("n")).distinct().collect():  # GRAM numbers at most
        part = b.select("b", F.explode(_grams(F.col("pb"), row["n"])).alias("gram")).join(short.where(F.length("gram") == row["n"]), "gram").select("b", "q", "quote", "pq")
        found = found.select("b", "q", "quote", "pq").unionByName(part)
    met = found.join(b, "b")
    return met.withColumns({"at": F.instr(F.col("text"), F.col("quote")).cast("long"), "loose": F.instr(F.col("pb"), F.col("pq")).cast("long")}).where("loose > 0")


def sampled_grams(texts: DataFrame, name: str) -> DataFrame:
    """(name, gram): of every STEP grams of GRAM characters in a row the one with the smallest hash, as its hash, once a text.

    Two texts that share GRAM + STEP - 1 characters share all the grams of one such row and with them its smallest, so a quote needs one gram to meet every text that holds it, and a text gives about
    two grams for STEP + 1 characters in place of all.
    """
    rows = texts.select(F.col("id").alias(name), F.encode("text", "UTF-32").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [winnowed(np.frombuffer(t or b"", dtype=">u4")) for t in batch.column("text").to_pylist()]
            at = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
            yield pa.RecordBatch.from_arrays([batch.column(name).take(pa.array(at)), pa.array(np.concatenate([*hashes, np.zeros(0, np.int64)]))], names=[name, "gram"])

    return rows.mapInArrow(run, f"{name} {rows.schema[name].dataType.simpleString()}, gram long")


def winnowed(codes: np.ndarray) -> np.ndarray:
    """Distinct smallest hashes of every STEP neighbouring grams; none for a text with fewer grams."""
    n = len(codes) - GRAM + 1
    if n < STEP:
        return np.zeros(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x100000001B3) + codes[k : k + n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(np.lib.stride_tricks.sliding_window_view(h, STEP).min(axis=1)).view(np.int64)


def _grams(text: Column, n: int) -> Column:
    """Distinct pieces of n characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substr(text, i, F.lit(n))))


def greedy_pairs(cells: DataFrame, headers: DataFrame, row: str, cell: str, header: str, at: str, max_distance: float) -> DataFrame:
    """(row, cell, header, distance): within a row the closest pair is taken first and both are used up; sequential by definition, one row at a time."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        pairs = sorted((abs(a - b), i, j) for i, a in zip(left[cell], left[at], strict=True) for j, b in zip(right[header], right[at], strict=True) if abs(a - b) <= max_distance)
        used_l, used_r, out = set(), set(), []
        for d, i, j in pairs:
            if i not in used_l and j not in used_r:
                used_l.add(i)
                used_r.add(j)
                out.append((key[0], i, j, d))
        return pd.DataFrame(out, columns=[row, cell, header, "distance"])

    types = [f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((cells, row), (cells, cell), (headers, header))]
    return cells.groupBy(row).cogroup(headers.groupBy(row)).applyInPandas(run, ", ".join([*types, "distance double"]))
