"""Typed graphs, scopes, owners and references between records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import specimen_type
from assaylake.operators.contracts import first_reason, small

#: Kinds of specimen that a recipe establishes by itself.
GENERIC_SPECIMENS = ("paste", "mortar", "concrete", "powder", "solution")


def graph_defects(edges: DataFrame, nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """`edges` (edge, kind, source, target, scope) with the first defect, null if sound.

    nodes: node, node_type; rules: kind, source_type, target_type (a short vocabulary). One source may have one target per kind and scope.
    """
    left = nodes.select(F.col("node").alias("source"), F.col("node_type").alias("_st"))
    right = nodes.select(F.col("node").alias("target"), F.col("node_type").alias("_tt"))
    allowed = rules.select("kind", F.col("source_type").alias("_rs"), F.col("target_type").alias("_rt"))
    met = edges.join(left, "source", "left").join(right, "target", "left").join(small(allowed), "kind", "left")
    scoped = Window.partitionBy("kind", "source", "scope")
    met = met.withColumn("_n", F.size(F.collect_set("target").over(scoped)))
    defect = first_reason((F.col("_rs").isNull(), "UNKNOWN_KIND"), (F.col("_st").isNull() | F.col("_tt").isNull(), "DANGLING_ENDPOINT"), ((F.col("_st") != F.col("_rs")) | (F.col("_tt") != F.col("_rt")), "ENDPOINT_TYPE"), (F.col("_n") > 1, "CONFLICTING_SCOPE"))
    return met.select(*edges.columns, defect.alias("defect"))


def expand_scope(cases: DataFrame, universe: DataFrame, case: str, group: str, item: str, includes: str, excludes: str) -> tuple[DataFrame, DataFrame]:
    """(members, defects): the included items of each case, and cases whose two lists overlap, leave items out or name foreign ones.

    The universe of a group is one row of items, so a case is checked by array functions without a join per item.
    """
    whole = universe.groupBy(group).agg(F.collect_set(item).alias("_all"))
    met = cases.join(whole, group, "left")
    both = F.array_union(includes, excludes)
    defect = first_reason(
        (F.col("_all").isNull(), "UNKNOWN_GROUP"), (F.arrays_overlap(includes, excludes), "OVERLAP"), (F.size(F.array_except(both, F.col("_all"))) > 0, "FOREIGN_ITEM"), (F.size(F.array_except(F.col("_all"), both)) > 0, "NOT_COVERED")
    )
    told = met.withColumn("defect", defect)
    return told.where("defect IS NULL").select(case, F.explode(includes).alias(item)), told.where("defect IS NOT NULL").select(case, "defect")


def resolve_owners(items: DataFrame, owners: DataFrame, item: str) -> DataFrame:
    """`items` (item, owner_key, specimen) with resolved_owner and status.

    An item stays with its owner unless its specimen names another kind; then the one owner with the same label and that kind, else AMBIGUOUS.
    owners: owner_key, label, specimen.
    """
    own = owners.select(F.col("owner_key").alias("_k"), F.col("label").alias("_label"), specimen_type(F.col("specimen")).alias("_kind"))
    met = items.join(own, items["owner_key"] == own["_k"], "left").withColumn("_wanted", specimen_type(F.col("specimen")))
    stays = F.col("_wanted").isNull() | (F.col("_wanted") == F.col("_kind"))
    others = own.groupBy(F.col("_label").alias("_l2"), F.col("_kind").alias("_k2")).agg(F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_other"))
    found = met.join(others, (F.col("_label") == F.col("_l2")) & (F.col("_wanted") == F.col("_k2")), "left")
    status = F.when(F.col("_k").isNull(), "UNKNOWN_OWNER").when(F.coalesce(stays, F.lit(True)), "KEPT").when(F.col("_n") == 1, "MOVED").otherwise("AMBIGUOUS")
    resolved = F.when(status == "KEPT", F.col("owner_key")).when(status == "MOVED", F.col("_other"))
    return found.select(*items.columns, resolved.alias("resolved_owner"), status.alias("status"))


def method_scope(observations: DataFrame, routes: DataFrame) -> DataFrame:
    """`observations` with the first of the reasons, in order, why a method does not cover them; null if it does.

    observations: record, name, slot_name, scope_ids (array), route_id, bound_route_id, row_id, age_seconds, specimen, method, method_sources (array), specimen_sources (array).
    routes: record, route_id, row_ids (array), excluded_row_ids (array), specimen_age_seconds, stage_status, specimen_kind.
    """
    r = routes.groupBy("record", "route_id").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("row_ids", "excluded_row_ids", "specimen_age_seconds", "stage_status", "specimen_kind")).alias("_r"))
    met = observations.join(r, ["record", "route_id"], "left")
    generic = F.col("specimen").isin(*GENERIC_SPECIMENS)
    some = lambda c: F.coalesce(F.size(F.array_intersect(F.col(c), F.col("scope_ids"))) > 0, F.lit(False))
    within = F.array_contains("_r.row_ids", F.col("row_id")) & ~F.coalesce(F.array_contains("_r.excluded_row_ids", F.col("row_id")), F.lit(False))
    reason = first_reason(
        (F.col("slot_name").isNotNull() & ~F.col("name").eqNullSafe(F.col("slot_name")), "PROPERTY_OUTSIDE_SLOT"),
        (F.coalesce(F.size("scope_ids"), F.lit(0)) <= 0, "METHOD_SOURCE_SCOPE_UNSPECIFIED"),
        (~(F.coalesce("_n", F.lit(0)) == 1), "PHYSICAL_ROUTE_UNRESOLVED"),
        (F.col("bound_route_id").isNotNull() & (F.col("bound_route_id") != F.col("route_id")), "ROUTE_BINDING_CONFLICT"),
        (~F.coalesce(within, F.lit(False)), "ROUTE_SUBJECT_SCOPE_UNRESOLVED"),
        (F.col("_r.specimen_age_seconds").isNotNull() & ~F.col("age_seconds").eqNullSafe(F.col("_r.specimen_age_seconds")), "ROUTE_AGE_CONFLICT"),
        (F.col("_r.stage_status") == "UNRESOLVED_TEST_STAGE", "ROUTE_TEST_STAGE_UNRESOLVED"),
        (F.col("_r.specimen_kind").isNull() | (F.coalesce("specimen", F.lit("")) == ""), "PHYSICAL_OBJECT_UNRESOLVED"),
        (generic & (F.col("specimen") != F.col("_r.specimen_kind")), "PHYSICAL_OBJECT_CONFLICT"),
        ((F.coalesce("method", F.lit("")) == "") | ~some("method_sources"), "ROUTE_METHOD_SOURCE_UNRESOLVED"),
        (~generic & ~some("specimen_sources"), "PHYSICAL_OBJECT_SOURCE_UNRESOLVED"),
    )
    return met.select(*observations.columns, reason.alias("reason"))


def precursor_members(assignments: DataFrame, parameters: DataFrame, materials: DataFrame) -> DataFrame:
    """(mix_key, mat_key, percent, defect): positive shares of parallel arrays with the one material that their source cell names.

    assignments: mix_key, paper_key, percents (array), evidence_keys (array); parameters: mix_key, evidence_key, label; materials: paper_key, mat_key, custom_id.
    """
    aligned = (F.size("percents") == F.size("evidence_keys")) & (F.size(F.array_distinct("evidence_keys")) == F.size("evidence_keys"))
    rows = assignments.withColumn("_ok", aligned).select("mix_key", "paper_key", "_ok", F.posexplode_outer(F.arrays_zip("percents", "evidence_keys")).alias("_i", "_z"))
    rows = rows.select("mix_key", "paper_key", "_ok", F.col("_z.percents").alias("percent"), F.col("_z.evidence_keys").alias("evidence_key"))
    fold = lambda c: F.lower(F.regexp_replace(c, r"\s+", ""))
    p = parameters.groupBy("mix_key", "evidence_key").agg(F.count(F.lit(1)).alias("_np"), F.min(fold("label")).alias("_label"))
    m = materials.groupBy("paper_key", fold("custom_id").alias("_label")).agg(F.count(F.lit(1)).alias("_nm"), F.min("mat_key").alias("mat_key"))
    met = rows.join(p, ["mix_key", "evidence_key"], "left").join(m, ["paper_key", "_label"], "left")
    defect = first_reason(
        (~F.col("_ok"), "ALIGNMENT"), (~F.coalesce(F.col("percent").between(0, 100), F.lit(False)), "PERCENTAGE"), (~(F.coalesce("_np", F.lit(0)) == 1), "SOURCE_CELL"), ((F.col("percent") > 0) & ~(F.coalesce("_nm", F.lit(0)) == 1), "MATERIAL")
    )
    return met.withColumn("defect", defect).where("defect IS NOT NULL OR percent > 0").select("mix_key", F.when(F.col("defect").isNull(), F.col("mat_key")).alias("mat_key"), "percent", "defect")


def reusable_values(slots: DataFrame, values: DataFrame, sources: DataFrame) -> DataFrame:
    """(slot, field_path, value, directness): known values under a slot's path whose evidence belongs to the record and lies in the slot's sources.

    slots: slot, record, path, source_ids (array); values: record, field_path, value, method, evidence_record, source_id.
    A null value is never a finding.
    """
    known = values.where("value IS NOT NULL AND evidence_record = record").join(sources.select("source_id").distinct(), "source_id", "left_semi")
    met = slots.join(known, "record")
    under = (F.col("field_path") == F.col("path")) | F.col("field_path").startswith(F.concat("path", F.lit("/")))
    direct = F.when(F.col("method").isin("derived", "calculated"), "derived").when(F.col("method").isin("estimate", "digitized"), "estimate").otherwise("direct")
    return met.where(under & F.array_contains("source_ids", F.col("source_id"))).select("slot", "field_path", "value", direct.alias("directness"))


def correctness_gate(items: DataFrame, paper: str, captured: Column, correct: Column, least_recall: float, least_correct: float) -> DataFrame:
    """(paper, n, recall, correctness, verdict) and one row without a paper for all of them."""
    got = items.groupingSets([[paper], []], paper).agg(F.count(F.lit(1)).alias("n"), (F.count_if(captured) / F.count(F.lit(1))).alias("recall"), F.try_divide(F.count_if(captured & correct), F.count_if(captured)).alias("correctness"))
    good = (F.col("recall") >= least_recall) & (F.coalesce("correctness", F.lit(0.0)) >= least_correct)
    return got.withColumn("verdict", F.when(good, "PASS").otherwise("REJECT"))


def batch_invariants(members: DataFrame) -> DataFrame:
    """One row of counts: members, distinct accepted contents, work done twice, keys used by several papers, isolated members with records.

    members: member, paper, content, status, record_key.
    """
    accepted = F.col("status") == "ACCEPTED"
    shared = members.where(accepted).groupBy("record_key").agg(F.count_distinct("paper").alias("_p")).where("_p > 1").agg(F.count(F.lit(1)).alias("keys_across_papers"))
    got = members.agg(
        F.count(F.lit(1)).alias("n_members"), F.count_distinct(F.when(accepted, F.col("content"))).alias("accepted_contents"), (F.count_if(accepted) - F.count_distinct(F.when(accepted, F.col("content")))).alias("duplicate_work"),
        F.count_if((F.col("status") == "ISOLATED") & F.col("record_key").isNotNull()).alias("isolated_with_records"),
    )
    return got.crossJoin(shared)  # one row each


def mirror_defects(published: DataFrame, mirror: DataFrame, key: str, content: str) -> DataFrame:
    """(key, defect) of published rows whose mirror has other contents (HASH_DIFFERS) or none (NOT_MIRRORED), and of mirrored ones that are not published (NOT_PUBLISHED); contents are compared by hash."""
    digest = lambda rows, name: rows.groupBy(key).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.sha2(F.col(content).cast("string").cast("binary"), 256))), ",").cast("binary"), 256).alias(name))
    met = digest(published, "_a").join(digest(mirror, "_b"), key, "full")
    defect = F.when(F.col("_b").isNull(), "NOT_MIRRORED").when(F.col("_a").isNull(), "NOT_PUBLISHED").when(F.col("_a") != F.col("_b"), "HASH_DIFFERS")
    return met.select(key, defect.alias("defect")).where("defect IS NOT NULL")


def promote(candidates: DataFrame, acceptances: DataFrame, bound: list[str]) -> DataFrame:
    """`candidates` with status FORMAL where an acceptance without defects has all the bound hashes, else CANDIDATE."""
    good = acceptances.where(F.coalesce(F.size("defects"), F.lit(0)) <= 0).where("verdict = 'ACCEPTED'").select(*bound).distinct().withColumn("_ok", F.lit(True))
    return candidates.join(good, bound, "left").withColumn("status", F.when(F.col("_ok"), "FORMAL").otherwise("CANDIDATE")).drop("_ok")
