"""Duplicates, precedence and entity resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.operators.graph import connected_components


def first_known(value: str, order: str) -> Column:
    """The first value in order that is neither null nor empty."""
    return F.min_by(value, F.when(F.col(value).isNotNull() & (F.col(value).cast("string") != ""), F.col(order)))


def union_of(value: str) -> Column:
    """Sorted distinct elements of an array column over a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(value))))


def merge_candidates(rows: DataFrame, identity: str, order: str, scalars: list[str], arrays: list[str], flags: list[str]) -> DataFrame:
    """One row per identity: first known scalars in order, unions of arrays, any of the flags. Rows without identity are left out."""
    aggs = [first_known(c, order).alias(c) for c in scalars] + [union_of(c).alias(c) for c in arrays] + [F.bool_or(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in flags]
    return rows.where(F.coalesce(F.col(identity), F.lit("")) != "").groupBy(identity).agg(*aggs, F.count(F.lit(1)).alias("n_merged"))


def keep_best(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of each key in order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def content_aliases(rows: DataFrame, content: str, item: str, canonical: str | None = None) -> DataFrame:
    """`rows` with canonical_id and status: the flagged item of equal contents, else the smallest one; the others are DUPLICATE_ALIAS.

    The smallest item of each content is aggregated before the join, so a content that holds a third of all rows is pre-aggregated.
    """
    flag = F.coalesce(F.col(canonical), F.lit(False)) if canonical else F.lit(False)
    best = rows.groupBy(F.col(content).alias("_c")).agg(F.min_by(item, F.struct((~flag).cast("int").alias("f"), F.col(item).alias("i"))).alias("canonical_id"))
    met = rows.join(best, F.col(content).eqNullSafe(F.col("_c"))).drop("_c")
    return met.withColumn("status", F.when(F.col("canonical_id") == F.col(item), "CANONICAL").otherwise("DUPLICATE_ALIAS"))


def by_precedence(rows: DataFrame, keys: list[str], source: str, value: str, precedence: list[str]) -> DataFrame:
    """(keys, value, source, n_values, conflict): the value of the best source; a conflict where that source says different things."""
    rank = F.coalesce(*[F.when(F.col(source) == s, i) for i, s in enumerate(precedence)], F.lit(len(precedence)))
    got = rows.withColumn("_rank", rank).groupBy(*keys, "_rank").agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_v"), F.min(source).alias("_s"))
    out = got.groupBy(*keys).agg(F.min_by(F.struct("_v", "_s", "_n"), "_rank").alias("_b"), F.sum("_n").alias("n_values"))
    return out.select(*keys, F.when(F.col("_b._n") == 1, F.col("_b._v")).alias(value), F.col("_b._s").alias(source), "n_values", (F.col("_b._n") > 1).alias("conflict"))


def alias_components(rows: DataFrame, item: str, aliases: list[str]) -> DataFrame:
    """(item, root): items that share any alias, directly or over others; root is the smallest item.

    Each alias links its items to its smallest one, so a common alias makes a star and no pairs.
    """
    edges = None
    for alias in aliases:
        least = rows.where(F.col(alias).isNotNull()).groupBy(F.col(alias).alias("_a")).agg(F.min(item).alias("_least"))
        part = rows.join(least, F.col(alias) == F.col("_a")).select(F.col(item).alias("_x"), "_least")
        edges = part if edges is None else edges.unionByName(part)
    roots = connected_components(edges, "_x", "_least")
    return rows.select(item).distinct().join(roots, F.col(item) == F.col("node"), "left").select(item, F.coalesce("root", item).alias("root"))


def resolve_entities(rows: DataFrame, item: str, aliases: list[str], doi: str) -> DataFrame:
    """(item, entity): the smallest item of the entity that each item belongs to.

    Components of aliases with one DOI at most are entities as they are. In the others items come one by one, in item order:
    an item joins, and so merges, all entities that its aliases lead to, but for those whose DOI contradicts its own; its aliases
    then lead to its entity. Sequential by definition, one component at a time.
    """
    comp = alias_components(rows, item, aliases)
    met = rows.join(comp, item)
    many = met.groupBy("root").agg(F.count_distinct(doi).alias("_n")).where("_n > 1").select("root")
    simple = met.join(many, "root", "left_anti").select(item, F.col("root").alias("entity"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        into: dict[object, object] = {}
        leads: dict[tuple[str, object], object] = {}
        known: dict[object, object] = {}

        def top(e: object) -> object:
            while into[e] != e:
                e = into[e]
            return e

        for row in pdf.sort_values(item).to_dict("records"):
            me, own = row[item], row[doi] if pd.notna(row[doi]) else None
            keys = [(a, row[a]) for a in aliases if pd.notna(row[a])]
            found = sorted({top(leads[k]) for k in keys if k in leads})
            found = [e for e in found if own is None or known[e] is None or known[e] == own]
            into[me] = root = found[0] if found else me
            for e in found:
                into[e], own = root, known[e] or own  # what was there before goes first
            known[root] = own
            leads |= dict.fromkeys(keys, root)
        return pd.DataFrame([(i, top(i)) for i in pdf[item]], columns=[item, "entity"])

    kind = rows.schema[item].dataType.simpleString()
    hard = met.join(many, "root").groupBy("root").applyInPandas(run, f"{item} {kind}, entity {kind}")
    return simple.unionByName(hard)


def ranked_entities(rows: DataFrame, item: str, identity: str, aliases: list[str], doi: str, scalars: list[str], arrays: list[str], flags: list[str], score: Column, order: list[Column | str]) -> DataFrame:
    """Entities in their total order: rows of one identity merged, entities resolved over the aliases and merged again, then scored anew and sorted.

    `score` and `order` read the merged columns; entity is the smallest item of each.
    """
    keep = [c for c in dict.fromkeys([*scalars, *aliases, doi]) if c != identity]
    first = merge_candidates(rows, identity, item, keep, arrays, flags).drop("n_merged").join(rows.groupBy(identity).agg(F.min(item).alias(item)), identity)
    entities = resolve_entities(first, item, aliases, doi)
    members = first.join(entities, item).withColumn("_entity", F.col("entity").cast("string"))
    merged = merge_candidates(members, "_entity", item, [c for c in dict.fromkeys([*scalars, doi])], arrays, flags).withColumnRenamed("_entity", "entity")
    scored = merged.withColumn("score", score)
    return scored.orderBy(F.desc("score"), *order, "entity")


def prefer_complete(rows: DataFrame, group: str, complete: Column) -> DataFrame:
    """Rows of each group, without the incomplete ones where the group has a complete one."""
    flagged = rows.withColumn("_c", F.coalesce(complete, F.lit(False)))
    return flagged.withColumn("_any", F.bool_or("_c").over(Window.partitionBy(group))).where("_c OR NOT _any").drop("_c", "_any")


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """`old` with the rows of `new` in place of those of the same key; unknown keys of `new` are an error."""
    unknown = new.join(old.select(key), key, "left_anti").limit(1).count()
    if unknown:
        raise ValueError("a replacement has a key that the table lacks")
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def fill_nulls(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, status): full outer merge that fills nulls; different known values are a CONFLICT with a null value."""
    a, b = left.select(key, F.col(value).alias("_a")), right.select(key, F.col(value).alias("_b"))
    met = a.join(b, key, "full")
    clash = F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b"))
    return met.select(key, F.when(~clash, F.coalesce("_a", "_b")).alias(value), F.when(clash, "CONFLICT").when(F.col("_a").isNull() & F.col("_b").isNotNull(), "FILLED").otherwise("KEPT").alias("status"))


def fill_leaves(left: DataFrame, right: DataFrame, record: str, path: str, value: str, kind: str) -> DataFrame:
    """(record, path, value, kind, status): the same merge over all leaves of nested records, whatever their depth.

    Different values or types are a CONFLICT, also a leaf on one side where the other has leaves below it.
    """
    keys = [record, path]
    a, b = (x.select(*keys, F.struct(F.col(value).alias("v"), F.col(kind).alias("t")).alias(n)) for x, n in ((left, "_a"), (right, "_b")))
    known = lambda c: F.col(c).isNotNull() & F.col(f"{c}.v").isNotNull()
    met = a.join(b, keys, "full")
    differ = known("_a") & known("_b") & ~(F.col("_a.v").eqNullSafe(F.col("_b.v")) & F.col("_a.t").eqNullSafe(F.col("_b.t")))
    parts = F.split(F.col(path), "/")
    above = F.transform(F.sequence(F.lit(2), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    leaves = met.select(*keys, known("_a").alias("_in_a"), known("_b").alias("_in_b"))
    below = leaves.where(F.size(parts) > 2).select(*keys, F.explode(above).alias("_up"), "_in_a", "_in_b")
    over = leaves.select(record, F.col(path).alias("_up"), F.col("_in_a").alias("_up_a"), F.col("_in_b").alias("_up_b"))
    pairs = below.join(over, [record, "_up"]).where("(_in_a AND _up_b) OR (_in_b AND _up_a)")
    crossing = pairs.select(*keys).unionByName(pairs.select(record, F.col("_up").alias(path))).distinct().withColumn("_crossed", F.lit(True))
    met = met.join(crossing, keys, "left")
    crossed = F.coalesce(F.col("_crossed"), F.lit(False))
    clash = differ | crossed
    kept = F.when(known("_a"), F.col("_a")).otherwise(F.coalesce("_b", "_a"))
    status = F.when(clash, "CONFLICT").when(~known("_a") & known("_b"), "FILLED").otherwise("KEPT")
    return met.select(*keys, F.when(~clash, kept["v"]).alias(value), F.when(~clash, kept["t"]).alias(kind), status.alias("status"))


def last_wins(rows: DataFrame, key: str, arrival: str, rank: dict[str, int], kind: str) -> DataFrame:
    """The last row of each key, with its place by the kind's rank (unknown kinds last), then the key."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), arrival).alias("_l")).select(key, "_l.*")
    places = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    return last.withColumn("rank", F.coalesce(places[F.col(kind)], F.lit(len(rank))))


def staged_writes(table: DataFrame, writes: DataFrame, key: str, value: str, unit: str) -> tuple[DataFrame, DataFrame]:
    """(table with the new keys, defects): an equal value and unit is no change; another value or another unit is a defect, and so are two writes of a key that differ."""
    agreed = writes.groupBy(key).agg(F.count_distinct(F.struct(value, unit)).alias("_n"), F.first(F.struct(value, unit)).alias("_w"))
    met = agreed.join(table.select(key, F.struct(value, unit).alias("_old")), key, "left")
    why = F.when(F.col("_n") > 1, "WRITES_DIFFER").when(F.col("_old").isNotNull() & ~F.col(f"_old.{unit}").eqNullSafe(F.col(f"_w.{unit}")), "UNIT_CONFLICT").when(F.col("_old").isNotNull() & ~F.col(f"_old.{value}").eqNullSafe(F.col(f"_w.{value}")), "VALUE_CONFLICT")
    told = met.withColumn("defect", why)
    fresh = told.where("defect IS NULL AND _old IS NULL").select(key, "_w.*")
    return table.select(key, value, unit).unionByName(fresh), told.where("defect IS NOT NULL").select(key, "defect")


def insert_if_equal(table: DataFrame, rows: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(table with the new keys, conflicts): writing an equal value again changes nothing, another one is a conflict."""
    met = rows.join(table.select(key, F.col(value).alias("_old")), key, "left")
    conflicts = met.where(F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.col(value))).drop("_old")
    fresh = rows.join(table.select(key), key, "left_anti")
    return table.unionByName(fresh.select(*table.columns)), conflicts


def rename_evidence(links: DataFrame, renames: DataFrame, key: str) -> DataFrame:
    """`links` with replaced keys; renames has old_key and new_key."""
    met = links.join(renames, F.col(key) == F.col("old_key"), "left")
    return met.withColumn(key, F.coalesce("new_key", key)).drop("old_key", "new_key")


def patch_region(points: DataFrame, patch: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Points outside the box with those of the patch inside it, without repetitions."""
    x0, y0, x1, y1 = map(F.lit, box)
    inside = F.col("x").between(x0, x1) & F.col("y").between(y0, y1)
    return points.where(~inside).unionByName(patch.where(inside)).distinct()


def same_rows(a: DataFrame, b: DataFrame, paths: dict[str, str] | None = None) -> DataFrame:
    """(side, n): rows of only one of the two, with multiplicity; empty for equal tables. `paths` names columns that hold a place, each with the column of its content's hash, which is compared instead."""
    for place, digest in (paths or {}).items():
        a, b = (x.withColumn(place, F.col(digest)) for x in (a, b))
    left, right = a.exceptAll(b).withColumn("side", F.lit("left")), b.exceptAll(a).withColumn("side", F.lit("right"))
    return left.unionByName(right).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def accepted_merge(candidates: DataFrame, plans: DataFrame, acceptances: DataFrame, key: list[str], rank: Column) -> tuple[DataFrame, DataFrame]:
    """(merged, rejected): candidates whose item was accepted for the plan that holds now, one for each key; all others with the reason.

    candidates: item, candidate, the key's columns and more; plans: item, plan_sha256 (one a item); acceptances: item, plan_sha256, verdict. Reasons, first that holds: NO_PLAN, NO_ACCEPTANCE, PLAN_CHANGED
    (accepted for another plan only), NOT_ACCEPTED (another verdict stands beside or instead), SUPERSEDED (another candidate of the key ranks before it; ties go to the smaller candidate).
    """
    told = acceptances.groupBy("item").agg(F.collect_set("plan_sha256").alias("_plans"), F.collect_set(F.struct("plan_sha256", "verdict")).alias("_said"))
    met = candidates.join(plans.select("item", F.col("plan_sha256").alias("_plan")), "item", "left").join(told, "item", "left")
    own = F.filter("_said", lambda x: x["plan_sha256"] == F.col("_plan"))
    reason = (
        F.when(F.col("_plan").isNull(), "NO_PLAN").when(F.col("_plans").isNull(), "NO_ACCEPTANCE").when(F.size(own) == 0, "PLAN_CHANGED")
        .when(F.exists(own, lambda x: ~x["verdict"].eqNullSafe(F.lit("ACCEPTED"))), "NOT_ACCEPTED")
    )
    judged = met.withColumn("reason", reason)
    first = Window.partitionBy(F.col("reason").isNull(), *key).orderBy(rank, "candidate")
    judged = judged.withColumn("reason", F.when(F.col("reason").isNull() & (F.row_number().over(first) > 1), "SUPERSEDED").otherwise(F.col("reason")))
    return judged.where("reason IS NULL").select(*candidates.columns), judged.where("reason IS NOT NULL").select("item", "candidate", *key, "reason")
