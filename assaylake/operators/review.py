"""Review: two layers of records paired with each other, and what may be shown.

Pairing goes by tiers of keys within a record (a mix, a paper): each tier is one equi-join of what the tiers before it have left free, with counts
that tell what is unique. Nothing is paired row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import coded_composition, fold
from assaylake.plans.storage import unsent, written

#: Names of one meaning.
LABELS = {"na2sio3percent": "na2sio3", "watertobinder": "wb", "waterbinder": "wb", "silicatemodulus": "ms", "h2o2masspercent": "h2o2", "spcmasspercent": "spc", "x2otosio2": "x2osio2", "h2otox2o": "h2ox2o"}
MATERIALS = {"ggbs": "slag", "ggbfs": "slag", "bfs": "slag", "groundgranulatedblastfurnaceslag": "slag", "fa": "flyash", "classfflyash": "flyash", "pc": "portlandcement", "rha": "ricehuskash", "fgr": "fluegasresidue", "calcinedkaolinmetakaolin": "calcinedkaolin"}
#: States of a field that still waits for repair.
REPAIR_STATES, REPAIR_CODES, REPAIR_WORD = ("evidence_blocked", "not_extracted"), ("SOURCE_EVIDENCE_BLOCKED", "SOURCE_LOCATED_NOT_TRANSCRIBED"), "待修复"

ITEM = "array<struct<label: string, value: string, unit: string>>"


def _named(text: Column, names: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(table[text], text)


def label_key(label: Column) -> Column:
    """A label's letters and digits in lower case, by its usual name."""
    plain = F.replace(F.regexp_replace(fold(F.coalesce(label, F.lit(""))), "[^a-z0-9]+", ""), F.lit("derived"), F.lit(""))
    return _named(plain, LABELS)


def material_key(name: Column) -> Column:
    return _named(label_key(name), MATERIALS)


def pair_materials(left: DataFrame, right: DataFrame, record: str, left_id: str, right_id: str, name: str, keep: Column | None = None) -> DataFrame:
    """(record, left_id, right_id): the first left material of a key with the right one that alone has it; then the right ones that are left over, where `keep` holds."""
    order = lambda i: Window.partitionBy(record, "_k").orderBy(i)
    a = left.select(record, F.col(left_id).alias("left_id"), material_key(F.col(name)).alias("_k")).withColumn("_turn", F.row_number().over(order("left_id")))
    b = right.withColumn("_keep", keep if keep is not None else F.lit(True)).select(record, F.col(right_id).alias("right_id"), material_key(F.col(name)).alias("_k"), "_keep")
    only = b.groupBy(record, "_k").agg(F.count(F.lit(1)).alias("_n"), F.min("right_id").alias("right_id")).where("_n = 1").select(record, "_k", "right_id", F.lit(1).alias("_turn"))
    pairs = a.join(only, [record, "_k", "_turn"], "left").select(record, "left_id", "right_id")
    rest = b.where("_keep").join(pairs.where("right_id IS NOT NULL").select(record, "right_id"), [record, "right_id"], "left_anti")
    return pairs.unionByName(rest.select(record, F.lit(None).cast(left.schema[left_id].dataType).alias("left_id"), "right_id"))


def value_key(value: Column) -> Column:
    """What makes two values equal: numbers to nine decimals, other texts as they are; null equals nothing."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("decimal(38,9)").cast("string"), text)


def paired_in_tiers(left: DataFrame, right: DataFrame, record: str, tiers: list[tuple[str, list[str], bool]]) -> tuple[DataFrame, DataFrame]:
    """(record, left_id, right_id, tier) and (record, left_id, error): rows paired by one key after another, each by an equi-join on what is still free.

    left: record, left_id, keys; right: record, right_id, keys, with a row for each key a right row can be known by. In a tier (name, keys, alarm) a right row that alone has its keys
    goes to the first left row with the same; several are an AMBIGUOUS error where the tier gives alarm, and that left row is then out. Rows with a null in a key take no part in a tier.
    """
    pairs, errors = None, None
    for name, keys, alarm in tiers:
        by = [record, *keys]
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        free_left, free_right = left.where(known), right.where(known)
        if pairs is not None:
            free_left, free_right = free_left.join(unsent(pairs), [record, "left_id"], "left_anti"), free_right.join(unsent(pairs), [record, "right_id"], "left_anti")
        if errors is not None:
            free_left = free_left.join(unsent(errors), [record, "left_id"], "left_anti")
        only = free_right.groupBy(*by).agg(F.count_distinct("right_id").alias("n"), F.min("right_id").alias("right_id"))
        met = free_left.join(unsent(only), by).withColumn("turn", F.row_number().over(Window.partitionBy(*by).orderBy("left_id")))
        # Pairs and errors of a tier are one table, so that its join runs once. Ids take few bytes in a file; by those the planner would broadcast millions of them.
        several = F.col("n") > 1
        told = met.where((several & F.lit(alarm)) | ((F.col("n") == 1) & (F.col("turn") == 1)))
        told = told.select(record, "left_id", F.when(~several, F.col("right_id")).alias("right_id"), F.when(several, F.lit(f"AMBIGUOUS_{name}")).alias("error"))
        first = Window.partitionBy(record, "right_id", F.when(F.col("error").isNotNull(), F.col("left_id"))).orderBy("left_id")
        told = written(told.withColumn("again", F.row_number().over(first)).where("again = 1").drop("again"))
        got = told.where("error IS NULL").select(record, "left_id", "right_id", F.lit(name).alias("tier"))
        pairs = got if pairs is None else pairs.unionByName(got)
        if alarm:
            bad = told.where("error IS NOT NULL").select(record, "left_id", "error")
            errors = bad if errors is None else errors.unionByName(bad)
    errors = errors if errors is not None else pairs.select(record, "left_id", F.col("tier").alias("error")).limit(0)
    return unsent(pairs), unsent(errors)


def pair_parameters(left: DataFrame, right: DataFrame, record: str, order: str, label: str, value: str, unit: str) -> DataFrame:
    """(record, left_order, right_order, error): parameters of one record paired by label, value and unit, then by label and value, then by a label alone where the left value is unknown.

    An unpaired left one is AMBIGUOUS beside several free right ones with its value, and a CONFLICT beside free ones with other values; unpaired right ones have no left_order.
    """
    unknown = "?"
    keyed = lambda rows, i: rows.select(record, F.col(order).alias(i), label_key(F.col(label)).alias("l"), F.coalesce(value_key(F.col(value)), F.lit(unknown)).alias("v"), label_key(F.col(unit)).alias("u"))
    a, b = keyed(left, "left_id"), keyed(right, "right_id")
    a = a.withColumn("bare", F.when(F.col("v") == unknown, F.lit(True)))
    pairs, _ = paired_in_tiers(a, b.withColumn("bare", F.lit(True)), record, [("UNIT", ["l", "v", "u"], False), ("VALUE", ["l", "v"], False), ("LABEL", ["l", "bare"], False)])
    rest = b.join(pairs, [record, "right_id"], "left_anti")
    same = rest.groupBy(record, "l", "v").agg(F.count(F.lit(1)).alias("equal"))
    called = rest.groupBy(record, "l").agg(F.count(F.lit(1)).alias("called"))
    alone = a.join(pairs, [record, "left_id"], "left_anti").join(same, [record, "l", "v"], "left").join(called, [record, "l"], "left")
    error = F.when(F.col("equal") > 0, "AMBIGUOUS").when((F.col("called") > 0) & F.col("bare").isNull(), "CONFLICT")
    none = lambda c: F.lit(None).cast(left.schema[order].dataType).alias(c)
    out = pairs.select(record, F.col("left_id").alias("left_order"), F.col("right_id").alias("right_order"), F.lit(None).cast("string").alias("error"))
    return out.unionByName(alone.select(record, F.col("left_id").alias("left_order"), none("right_order"), error.alias("error"))).unionByName(rest.select(record, none("left_order"), F.col("right_id").alias("right_order"), F.lit(None).cast("string").alias("error")))


def pair_performance(left: DataFrame, right: DataFrame, record: str, order: str) -> DataFrame:
    """(record, left_order, right_order, tier, error): measured results of two layers by name, value and unit, in their context of age, specimen and method first.

    Both sides: record, order, name, value, unit, age, specimen, method; right ones may carry original_value and original_unit, by which they are known as well. Where one context fits several,
    or none does and several values fit, the left row is AMBIGUOUS; unpaired right ones have no left_order. An empty context equals an empty context.
    """
    said = lambda c: F.coalesce(value_key(F.col(c)), F.lit("?")) if c == "age" else label_key(F.col(c))
    context = [said(c).alias(c) for c in ("age", "specimen", "method")]
    keyed = lambda rows, i: rows.select(record, F.col(order).alias(i), label_key(F.col("name")).alias("name"), value_key(F.col("_w.value")).alias("v"), label_key(F.col("_w.unit")).alias("u"), *context, F.col("_w.own").alias("own"))
    way = lambda value, unit, own: F.struct(F.col(value).cast("string").alias("value"), F.col(unit).alias("unit"), F.lit(own).alias("own"))
    ways = F.array(way("value", "unit", True), way("original_value", "original_unit", False)) if "original_value" in right.columns else F.array(way("value", "unit", True))
    scalar = ["name", "v", "u"]
    # The keys of both sides are made once: each tier reads them twice.
    a = written(keyed(left.withColumn("_w", way("value", "unit", True)), "left_id").drop("own"))
    known = written(keyed(right.withColumn("_w", F.explode(ways)).where("_w.own OR _w.value IS NOT NULL"), "right_id"))
    own = known.where("own")
    pairs, errors = paired_in_tiers(a, known, record, [("CONTEXT", [*scalar, "age", "specimen", "method"], True), ("SCALAR", scalar, True)])
    rest = own.select(record, "right_id").join(pairs, [record, "right_id"], "left_anti")
    alone = a.select(record, "left_id").join(pairs, [record, "left_id"], "left_anti").join(errors, [record, "left_id"], "left")
    none = lambda c: F.lit(None).cast(left.schema[order].dataType if c.endswith("order") else "string").alias(c)
    out = pairs.select(record, F.col("left_id").alias("left_order"), F.col("right_id").alias("right_order"), "tier", none("error"))
    return out.unionByName(alone.select(record, F.col("left_id").alias("left_order"), none("right_order"), none("tier"), "error")).unionByName(rest.select(record, none("left_order"), F.col("right_id").alias("right_order"), none("tier"), none("error")))


def shares_key(identity: Column) -> Column:
    """The composition that an identity such as C70G30U0 spells, without parts of nothing; null for others."""
    parts = F.filter(F.map_entries(coded_composition(F.trim(identity))), lambda e: e["value"] > 0)
    return F.to_json(F.array_sort(parts))


def overlaps(left: DataFrame, right: DataFrame, record: str) -> DataFrame:
    """(record, left_id, right_id, score): mixes of which one's key begins with the other's, by the number of parameters on which they agree.

    Keys meet by an equi-join on their beginnings. Of several right parameters of a label those of the same unit count, if there are any; an agreement is one equal value among them.
    """
    ends = lambda rows, i: rows.where("key != ''").select(record, i, "key", "items", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(record, i, "items", F.col("n") == F.length("key"), F.expr("left(key, n)").alias("start")).toDF(record, i, f"items_{i}", f"whole_{i}", "start")
    met = ends(left, "left_id").join(ends(right, "right_id"), [record, "start"]).where("whole_left_id OR whole_right_id")
    near = met.select(record, "left_id", "right_id", "items_left_id", "items_right_id").distinct()
    asked = near.select(record, "left_id", "right_id", "items_right_id", F.posexplode("items_left_id").alias("place", "a"))
    alike = F.filter("items_right_id", lambda b: b["label"] == F.col("a.label"))
    united = F.filter(alike, lambda b: b["unit"] == F.col("a.unit"))
    able = F.when((F.size(alike) > 1) & (F.size(united) > 0), united).otherwise(alike)
    agrees = F.size(F.filter(able, lambda b: value_key(b["value"]).eqNullSafe(value_key(F.col("a.value"))))) == 1
    return asked.groupBy(record, "left_id", "right_id").agg(F.count_if(agrees).alias("score")).where("score > 0")


def pair_mixes(left: DataFrame, right: DataFrame, paper: str, mix: str) -> DataFrame:
    """(paper, left_mix, right_mix, tier, error): mixes of one paper in three tiers: the same row of a table, the same identity, and beginnings of identities with most parameters in common.

    Both sides: paper, mix, identity, source_table, source_row, items (ITEM, of the mix's parameters), bare (whether it has no observation). A right mix that several left ones
    want goes to the first. Left mixes that only repeat the composition of a paired one are left out; unpaired right ones have no left_mix.
    """
    items = F.transform(F.coalesce("items", F.array().cast(ITEM)), lambda x: F.struct(label_key(x.label).alias("label"), x.value.alias("value"), label_key(x.unit).alias("unit")))
    table = F.nullif(label_key(F.col("source_table")), F.lit(""))
    keyed = lambda rows, i: written(rows.select(paper, F.col(mix).alias(i), label_key(F.col("identity")).alias("key"), table.alias("tab"), F.col("source_row").cast("long").alias("row"), items.alias("items"), F.coalesce("bare", F.lit(False)).alias("bare"), shares_key(F.col("identity")).alias("shares")))
    a, b = keyed(left, "left_id"), keyed(right, "right_id")
    pairs, errors = paired_in_tiers(a, b, paper, [("ANCHOR", ["tab", "row"], True), ("IDENTITY", ["key"], False)])
    free = a.join(pairs, [paper, "left_id"], "left_anti").join(errors, [paper, "left_id"], "left_anti")
    scored = overlaps(free, b.join(pairs, [paper, "right_id"], "left_anti"), paper)
    best = scored.withColumn("top", F.max("score").over(Window.partitionBy(paper, "left_id"))).where("score = top")
    counted = written(best.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(paper, "left_id"))))
    turn = F.row_number().over(Window.partitionBy(paper, "right_id").orderBy("left_id"))
    pairs = pairs.unionByName(counted.where("n = 1").withColumn("turn", turn).where("turn = 1").select(paper, "left_id", "right_id", F.lit("OVERLAP").alias("tier")))
    errors = errors.unionByName(counted.where("n > 1").select(paper, "left_id", F.lit("AMBIGUOUS_OVERLAP").alias("error")).distinct())
    known = a.join(pairs, [paper, "left_id"], "left_semi").where("shares IS NOT NULL").select(paper, "shares").distinct().withColumn("repeats", F.lit(True))
    alone = a.join(pairs, [paper, "left_id"], "left_anti").join(errors, [paper, "left_id"], "left").join(known, [paper, "shares"], "left")
    shown = alone.where("error IS NOT NULL OR NOT bare OR repeats IS NULL")
    rest = b.join(pairs, [paper, "right_id"], "left_anti")
    none = lambda c: F.lit(None).cast(left.schema[mix].dataType if c.endswith("mix") else "string").alias(c)
    out = pairs.select(paper, F.col("left_id").alias("left_mix"), F.col("right_id").alias("right_mix"), "tier", none("error"))
    return out.unionByName(shown.select(paper, F.col("left_id").alias("left_mix"), none("right_mix"), none("tier"), "error")).unionByName(rest.select(paper, none("left_mix"), F.col("right_id").alias("right_mix"), none("tier"), none("error")))



def waits_for_repair(blocked: Column, status: Column, code: Column, status_label: Column, reason: Column) -> Column:
    """Whether any of a field's marks says that it still waits for repair."""
    said = F.contains(F.concat_ws(" ", status_label, reason), F.lit(REPAIR_WORD))
    return F.coalesce(blocked, F.lit(False)) | F.coalesce(status.isin(*REPAIR_STATES), F.lit(False)) | F.coalesce(code.isin(*REPAIR_CODES), F.lit(False)) | said


def public_fields(fields: DataFrame, page_evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fields to show, defects) of fields (card, card_group, status, value, evidence_key, repair) and evidence_key rows that pages show.

    System notes and quarantined cards with a field under repair are not shown. A field under repair elsewhere, and a
    reported value whose evidence no page shows, are defects.
    """
    held = fields.withColumn("_bad", F.bool_or("repair").over(Window.partitionBy("card")))
    shown = held.where(~(F.col("card_group") == "quarantined") | ~F.col("_bad")).where((F.col("status") != "system_note") | (F.col("card_group") == "quarantined")).drop("_bad")
    seen = shown.join(page_evidence.select("evidence_key").distinct().withColumn("_seen", F.lit(True)), "evidence_key", "left")
    valued = (F.col("status") == "reported") & (F.coalesce(F.col("value"), F.lit("")) != "")
    why = F.when(F.col("repair"), "REPAIR_STATE").when(valued & F.col("_seen").isNull(), "NO_PUBLIC_EVIDENCE")
    defects = seen.select("card", "status", "value", why.alias("defect")).where("defect IS NOT NULL")
    return shown, defects


#: What a null may mean.
NULL_STATES = ("not_reported", "not_applicable", "unreadable", "quarantined")


def typed_nulls(fields: DataFrame, value: str, state: str) -> tuple[DataFrame, DataFrame]:
    """(fields with a value, nulls with their state); a null of an unknown state is an error when it is read."""
    known = F.when(F.col(state).isin(*NULL_STATES), F.col(state)).otherwise(F.raise_error(F.concat(F.lit("unknown null state: "), F.coalesce(F.col(state), F.lit("none")))))
    return fields.where(F.col(value).isNotNull()), fields.where(F.col(value).isNull()).withColumn(state, known)
