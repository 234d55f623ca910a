"""Documents as claims: one row per leaf, and back, exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.json_paths import escape_token
from assaylake.plans.storage import dealt

FIELDS = "collection string, record_key string, field_path string, value string, value_type string"


def flatten(rows: DataFrame, key: str, collection: str, columns: list[str] | None = None) -> DataFrame:
    """(collection, record_key, field_path, value, value_type, value_status): one claim per cell of a flat table.

    One array of structs per row and one explode: the table is read once whatever its width.
    """
    names = columns or [c for c in rows.columns if c != key]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    leaves = F.array(*[F.struct(F.concat(F.lit("/"), escape_token(F.lit(c))).alias("field_path"), F.col(c).cast("string").alias("value"), F.lit(kinds[c]).alias("value_type")) for c in names])
    out = rows.select(F.lit(collection).alias("collection"), F.col(key).cast("string").alias("record_key"), F.explode(leaves).alias("_l")).select("collection", "record_key", "_l.*")
    return out.withColumn("value_status", F.when(F.col("value").isNull(), "not_reported").otherwise("reported"))


def flatten_json(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(record_key, field_path, value): all leaves of JSON texts; empty containers are leaves as they are.

    Level by level: the objects and arrays of a level are opened, the others wait, until nothing is left to open; a level ends
    in a written table of its leaves and of what is in its containers, so each text is parsed once and the plan does not grow with the depth.
    """
    from assaylake.plans.registry import spread
    from assaylake.plans.storage import written

    now = rows.select(F.col(key).cast("string").alias("record_key"), F.lit("").alias("field_path"), F.col(text).alias("value"))
    kind = F.when(F.col("value").rlike(r"^\s*[{\[]"), F.schema_of_variant(F.try_parse_json("value")))  # no other text is a container
    is_map = F.col("_k").startswith("OBJECT") & (F.size(F.json_object_keys("value")) > 0)
    is_list = F.col("_k").startswith("ARRAY") & (F.json_array_length("value") > 0)
    item = lambda t, value, leaf: F.struct(t.cast("string").alias("t"), value.alias("value"), F.lit(leaf).alias("leaf"))
    within = F.when(is_map, F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: item(e["key"], e["value"], False)))
    within = within.when(is_list, F.transform(F.from_json("value", "array<string>"), lambda v, i: item(i, v, False))).otherwise(F.array(item(F.lit(None), F.col("value"), True)))
    path = F.when(F.col("_i.leaf"), F.col("field_path")).otherwise(F.concat("field_path", F.lit("/"), escape_token(F.col("_i.t"))))
    out = None
    while True:
        told = written(spread(now).withColumn("_k", kind).select("record_key", "field_path", F.explode(within).alias("_i")).select("record_key", path.alias("field_path"), "_i.value", "_i.leaf"))
        leaves = told.where("leaf").drop("leaf")
        out = leaves if out is None else out.unionByName(leaves)
        now = told.where("NOT leaf").drop("leaf")
        if now.isEmpty():
            return out


def assemble(claims: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row per record_key with the named fields in their types; the pivot list is given, so no scan looks for it."""
    cells = [F.max(F.when(F.col("field_path") == "/" + name.replace("~", "~0").replace("/", "~1"), F.col("value"))).cast(kind).alias(name) for name, kind in fields.items()]
    return claims.groupBy("record_key").agg(*cells)


def completeness(plan: DataFrame, found: DataFrame, key: str, group: str) -> DataFrame:
    """(group, planned, captured, missing, coverage, verdict) of planned items against dispositions."""
    held = found.select(key).distinct().withColumn("_f", F.lit(1))
    got = plan.join(held, key, "left").groupBy(group).agg(F.count(F.lit(1)).alias("planned"), F.count("_f").alias("captured"))
    return got.withColumns({"missing": F.col("planned") - F.col("captured"), "coverage": F.col("captured") / F.col("planned"), "verdict": F.when(F.col("captured") == F.col("planned"), "COMPLETE").otherwise("INCOMPLETE")})


def provenance_reason(expected: DataFrame, provenance: DataFrame, evidence: DataFrame, max_page: Column) -> DataFrame:
    """`expected` (record_key, field_path) with the first reason against its provenance, null if sound.

    provenance: record_key, field_path, evidence_key; evidence: evidence_key, evidence_record, page.
    """
    p = provenance.select("record_key", "field_path", "evidence_key")
    met = expected.join(p, ["record_key", "field_path"], "left").join(evidence, "evidence_key", "left")
    reason = (
        F.when(F.col("evidence_key").isNull(), "missing_provenance").when(F.col("evidence_record").isNull(), "missing_evidence").when(F.col("evidence_record") != F.col("record_key"), "evidence_mismatch")
        .when(F.coalesce((F.col("page") < 1) | (F.col("page") > max_page), F.lit(True)), "invalid_page")
    )
    return met.select(*expected.columns, reason.alias("reason"))


def validate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, defects, verdict, fingerprint) of named tables of defects: each check is one aggregate, all are one union."""
    parts = None
    for name, bad in checks.items():
        one = bad.agg(F.count(F.lit(1)).alias("defects")).select(F.lit(name).alias("check"), "defects")
        parts = one if parts is None else parts.unionByName(one)
    out = parts.withColumn("verdict", F.when(F.col("defects") == 0, "PASS").otherwise("REJECT"))
    failed = F.array_join(F.array_sort(F.collect_list(F.when(F.col("defects") > 0, F.col("check")))), ",")
    return out.crossJoin(out.agg(F.sha2(failed.cast("binary"), 256).alias("fingerprint")))  # one row beside a few


def repeated_defects(rejections: DataFrame, run: str, fingerprint: str, at: str, limit: int = 2) -> DataFrame:
    """`rejections` with stop: whether the same fingerprint has come `limit` times for the run."""
    from pyspark.sql import Window

    return rejections.withColumn("stop", F.count(F.lit(1)).over(Window.partitionBy(run, fingerprint).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)) >= limit)


#: How a component's assessment ends.
CAPTURED, VALIDATED, PARTIAL, ABSENT, UNPLANNED = "CAPTURED", "VALIDATED", "PARTIALLY_VALIDATED", "MISSING", "UNPLANNED"


def component_assessment(plan: DataFrame, values: DataFrame) -> DataFrame:
    """(record, component, n_planned, n_captured, n_validated, assessment) per component of a record.

    plan: record, component, item; values: record, component, item, validated. Captured items that nobody planned make a component UNPLANNED.
    """
    keys = ["record", "component", "item"]
    # Both sides are one union, which is dealt once; a key with a null meets no other side's, as in a join.
    side = lambda n: F.when(F.greatest(*[F.col(k).isNull() for k in keys]), n).otherwise(0).alias("_side")
    wanted = plan.select(*keys, side(1), F.lit(True).alias("_p"), F.lit(None).cast("boolean").alias("_v"))
    held = values.select(*keys, side(2), F.lit(None).cast("boolean").alias("_p"), F.coalesce("validated", F.lit(False)).alias("_v"))
    met = dealt(wanted.unionByName(held), "record", "component").groupBy(*keys, "_side").agg(F.bool_or("_p").alias("_p"), F.bool_or("_v").alias("_v"))
    got = met.groupBy("record", "component").agg(F.count_if("_p").alias("n_planned"), F.count_if(F.col("_v").isNotNull() & F.col("_p")).alias("n_captured"), F.count_if(F.col("_v") & F.col("_p")).alias("n_validated"), F.count_if(F.col("_p").isNull()).alias("_more"))
    n, seen, sound = F.col("n_planned"), F.col("n_captured"), F.col("n_validated")
    assessment = F.when((n == 0) | (F.col("_more") > 0), UNPLANNED).when(seen == 0, ABSENT).when(sound == n, VALIDATED).when(sound > 0, PARTIAL).otherwise(CAPTURED)
    return got.withColumn("assessment", assessment).drop("_more")


def run_counters(claims: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """One row of counters of a run's claims (collection, record_key, field_path, value): for each name the records of a collection, or its known values under a path."""
    cells = []
    for name, (collection, path) in names.items():
        here = F.col("collection") == collection
        under = here & F.startswith(F.col("field_path"), F.lit(path)) & F.col("value").isNotNull()
        cells.append((F.count_if(under) if path else F.count_distinct(F.when(here, F.col("record_key")))).alias(name))
    return claims.agg(*cells)


def event_counters(events: DataFrame, group: list[str], kind: str, counters: dict[str, tuple[str, ...]], sums: dict[str, tuple[str, str]]) -> DataFrame:
    """Counts of events of the named kinds and sums of a number over one kind, for each group: one aggregate over the log."""
    cells = [F.count_if(F.col(kind).isin(*kinds)).alias(name) for name, kinds in counters.items()]
    cells += [F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(c))), F.lit(0)).alias(name) for name, (k, c) in sums.items()]
    return events.groupBy(*group).agg(*cells)


def review_queue(papers: DataFrame, cards: DataFrame, fields: DataFrame) -> DataFrame:
    """One nested row per paper: its cards in order, each with its fields in order, and a hash of the whole, for `df.write.json`.

    papers: paper, title; cards: paper, card, place, label; fields: card, place, label, value, status. A paper's queue is one value.
    """
    own = fields.groupBy("card").agg(F.array_sort(F.collect_list(F.struct("place", "label", "value", "status"))).alias("fields"))
    shown = cards.join(own, "card", "left").select("paper", "place", "card", "label", F.coalesce("fields", F.array().cast(own.schema["fields"].dataType)).alias("fields"))
    queue = shown.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("place", "card", "label", "fields"))).alias("cards"))
    met = papers.join(queue, "paper", "left")
    return met.withColumn("queue_sha256", F.sha2(F.to_json(F.struct("paper", "cards"), {"ignoreNullFields": "false"}).cast("binary"), 256))
