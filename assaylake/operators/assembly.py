"""Records assembled from facts: source parameters into modules, chart items onto records, formulations, routes and designs.

Every operator gives the rows that found their place and, beside them, those that did not with the first reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.operators.contracts import first_reason

#: Units of amounts, units of ratios, and the roles that go with them.
AMOUNT_UNITS, RATIO_UNITS = ("wt.%", "%", "g", "kg", "kg/m3", "vol.%"), ("%", "ratio", "molar ratio", "mass ratio", "volume ratio")
AMOUNT_ROLE, RATIO_ROLES = "solid_fraction", ("replacement_fraction", "reported_ratio", "reported_dosage")
#: Kinds of specimen that a figure may name.
SPECIMENS = ("paste", "mortar", "concrete", "powder")
SAME_BOX = 0.02


def plain_label(text: Column, unit: Column) -> Column:
    """A label without its unit in brackets and without white space, in lower case."""
    return F.lower(F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.concat(F.lit("("), F.coalesce(unit, F.lit("")), F.lit(")")), F.lit("")), r"\s+", ""))


def basis_key(text: Column) -> Column:
    """What a basis divides by what, in order: "a / b", "a divided by b" and "a relative to b" are the same."""
    parts = F.split(F.lower(text), r"\s*(/|\bdivided\s+by\b|\brelative\s+to\b)\s*")
    return F.array_join(F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), "/")


def project_parameters(parameters: DataFrame, mats: DataFrame, existing: DataFrame) -> DataFrame:
    """`parameters` with destination, row_index and outcome: added, rebound, reused, or a deferral or conflict with its reason.

    parameters: mix, paper, place, label, role, unit, original_unit, provenance_unit, value, original_value, basis, mat, evidence, evidence_bound,
    cell (asset, page and box as one text). mats: mat, paper. existing: mix, destination, row_index, name, mat, value, unit, basis, evidence, cell.
    A parameter finds the one existing row of its material with its cell or label; equal numbers alone are no identity.
    """
    known = mats.select(F.col("mat").alias("_m"), F.col("paper").alias("_mp"))
    rows = parameters.join(known, F.col("mat") == F.col("_m"), "left")
    direct = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")) & (F.col("original_value").try_cast("double") == F.col("value"))
    solid = (F.col("role") == AMOUNT_ROLE) & F.col("mat").isNotNull() & F.col("unit").isin(*AMOUNT_UNITS)
    ratio = F.col("role").isin(*RATIO_ROLES) & F.col("unit").isin(*RATIO_UNITS)
    rows = rows.withColumn("destination", F.when(solid, "solid_materials").when(ratio, "platform_ratios")).withColumn("_target", F.when(solid, F.col("mat")))
    early = first_reason(
        (~F.coalesce("evidence_bound", F.lit(False)), "DEFERRED:parameter evidence needs association"),
        (~(F.col("original_unit").eqNullSafe(F.col("unit")) & F.col("provenance_unit").eqNullSafe(F.col("unit"))), "DEFERRED:unit conversion needs association"),
        ((F.coalesce(F.col("basis"), F.lit("")) == "") | F.col("value").isNull(), "DEFERRED:basis or value unavailable"),
        (~F.coalesce(direct, F.lit(False)), "DEFERRED:composite or converted value"),
        (F.col("mat").isNotNull() & ~F.coalesce(F.col("_mp") == F.col("paper"), F.lit(False)), "DEFERRED:material identity needs association"),
        (F.col("destination").isNull(), "DEFERRED:role and unit have no destination"),
    )
    rows = rows.withColumn("_early", early)
    e = existing.select("mix", "destination", F.col("mat").alias("_target"), "row_index", F.col("name").alias("_name"), F.col("value").alias("_v"), F.col("unit").alias("_u"), F.col("basis").alias("_b"), F.col("evidence").alias("_e"), F.col("cell").alias("_c"))
    met = rows.where("_early IS NULL").select("mix", "place", "destination", F.col("_target").alias("_t"), "label", "unit", "value", "cell").join(e.withColumnRenamed("_target", "_et"), ["mix", "destination"]).where(F.col("_t").eqNullSafe(F.col("_et")))
    identical = F.coalesce(F.col("cell") == F.col("_c"), F.lit(False)) | (plain_label(F.col("_name"), F.col("unit")) == plain_label(F.col("label"), F.col("unit")))
    alike = (F.col("_v") == F.col("value")) & (F.col("_u") == F.col("unit"))
    found = met.groupBy("mix", "place").agg(F.count_if(identical).alias("_n"), F.count_if(F.coalesce(alike, F.lit(False)) & ~identical).alias("_alike"), F.min(F.when(identical, F.struct("row_index", "_v", "_u", "_b", "_e"))).alias("_old"))
    out = rows.join(found, ["mix", "place"], "left")
    old, n = F.col("_old"), F.coalesce("_n", F.lit(0))
    late = first_reason(
        (n > 1, "CONFLICT:several existing rows of this identity"),
        ((n == 0) & (F.coalesce("_alike", F.lit(0)) > 0), "DEFERRED:equal numbers are no identity"),
        ((n == 1) & ((old["_v"] != F.col("value")) | (old["_u"].isNotNull() & (old["_u"] != F.col("unit")))), "CONFLICT:existing value or unit differs"),
        ((n == 1) & (F.coalesce(old["_b"], F.lit("")) != "") & (old["_b"] != "NOT_APPLICABLE") & (basis_key(old["_b"]) != basis_key(F.col("basis"))), "DEFERRED:basis equivalence not established"),
    )
    reason = F.coalesce("_early", late)
    outcome = F.coalesce(reason, F.when(n == 0, "added").when(old["_e"] == F.concat(F.lit("ev-source-"), F.col("evidence")), "reused").otherwise("rebound"))
    last = existing.groupBy("mix", "destination").agg(F.max("row_index").alias("_last"))
    turn = F.row_number().over(Window.partitionBy("mix", "destination", outcome == "added").orderBy("place"))
    placed = out.join(last, ["mix", "destination"], "left").withColumn("outcome", outcome).withColumn("_turn", turn)
    index = F.when(F.col("outcome") == "added", F.coalesce("_last", F.lit(-1)) + F.col("_turn")).when(F.col("outcome").isin("rebound", "reused"), old["row_index"]).cast("long")
    return placed.select(*parameters.columns, "destination", index.alias("row_index"), "outcome")


def chart_items(items: DataFrame, owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items on their record, items that stay with the figure) of items (figure, series, x, y, specimen) and owners (figure, series, specimen, mix).

    An item belongs to the one mix that owns its series and specimen (an owner without a specimen owns all of the series); with none or several owners it stays, with the reason.
    """
    keys = ["figure", "series"]
    own = owners.groupBy(*keys, "specimen").agg(F.count_distinct("mix").alias("_n"), F.min("mix").alias("_mix"))
    exact = own.where("specimen IS NOT NULL").withColumnsRenamed({"_n": "_n1", "_mix": "_m1"})
    wide = own.where("specimen IS NULL").drop("specimen").withColumnsRenamed({"_n": "_n2", "_mix": "_m2"})
    met = items.join(exact, [*keys, "specimen"], "left").join(wide, keys, "left")
    n, mix = F.coalesce("_n1", "_n2"), F.when(F.col("_n1").isNotNull(), F.col("_m1")).otherwise(F.col("_m2"))
    out = met.select(*items.columns, F.when(n == 1, mix).alias("mix"), F.when(n.isNull(), "UNASSIGNED").when(n > 1, "AMBIGUOUS_OWNER").alias("reason"))
    return out.where("reason IS NULL").drop("reason"), out.where("reason IS NOT NULL").drop("mix")


def resolve_formulations(points: DataFrame, assignments: DataFrame, mixes: DataFrame, spans: DataFrame) -> DataFrame:
    """(figure, x, test_id, mix, reference, status) of each printed x of a figure: by the source's own statement, never by an equal composition.

    points: figure, x; assignments: figure, x, test_id, reference_id, specimens, span_ids, tokens; mixes: mix, test_id, specimen; spans: span_id, text.
    An x needs exactly one assignment whose spans exist and hold its tokens, one of which is the number; then the one live mix of its only specimen.
    """
    xs = points.select("figure", "x").distinct()
    said = assignments.groupBy("figure", "x").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("test_id", "reference_id", "specimens", "span_ids", "tokens")).alias("_a")).select("figure", "x", "_n", "_a.*")
    asked = said.select("figure", "x", F.explode_outer("span_ids").alias("span_id"))
    asked = asked.join(spans, "span_id", "left").groupBy("figure", "x").agg(F.count_if(F.col("text").isNull()).alias("_lost"), F.concat_ws("\n", F.collect_list("text")).alias("_text"))
    met = xs.join(said, ["figure", "x"], "left").join(asked, ["figure", "x"], "left")
    printed = F.exists("tokens", lambda t: F.regexp_replace(t, r"^[ ,;()%*]+|[ ,;()%*.]+$", "").try_cast("double") == F.col("x"))
    proven = (F.col("_lost") == 0) & F.forall("tokens", lambda t: F.contains(F.col("_text"), t))
    known = (F.size("specimens") > 0) & F.forall("specimens", lambda s: s.isin(*SPECIMENS))
    early = first_reason((F.col("_n").isNull(), "NO_ASSIGNMENT"), (F.col("_n") > 1, "AMBIGUOUS_AXIS_VALUE"), (~F.coalesce(known, F.lit(False)), "SPECIMEN_UNRESOLVED"), (~F.coalesce(proven, F.lit(False)), "SOURCE_SPAN_MISSING"), (~F.coalesce(printed, F.lit(False)), "AXIS_VALUE_NOT_PRINTED"))
    only = F.when(F.size("specimens") == 1, F.get("specimens", F.lit(0)))
    met = met.select("figure", "x", "test_id", "reference_id", only.alias("_only"), early.alias("_early"))
    live = mixes.groupBy("test_id", "specimen").agg(F.count_distinct("mix").alias("_live"), F.min("mix").alias("_mix"), F.max(F.lit(0)).cast("long").alias("_spare"))
    for name, test in (("own", "test_id"), ("ref", "reference_id")):
        # Rows without a test or specimen meet nothing; a spare key of their own keeps them from gathering in one task.
        spare = F.when(F.col(test).isNull() | F.col("_only").isNull(), F.xxhash64("figure", "x")).otherwise(F.lit(0).cast("long"))
        there = live.select(F.col("test_id").alias("_t"), F.col("specimen").alias("_s"), F.col("_spare").alias("_k"), F.col("_live").alias(f"_{name}_n"), F.col("_mix").alias(f"_{name}_mix"))
        met = met.withColumn("_spare", spare).join(there, (F.col(test) == F.col("_t")) & (F.col("_only") == F.col("_s")) & (F.col("_spare") == F.col("_k")), "left").drop("_t", "_s", "_k", "_spare")
    status = F.coalesce("_early", first_reason((F.coalesce("_own_n", F.lit(0)) != 1, "OBSERVATION_UNBOUND"), (F.col("reference_id").isNotNull() & (F.coalesce("_ref_n", F.lit(0)) != 1), "REFERENCE_UNBOUND")), F.lit("RESOLVED"))
    return met.select("figure", "x", "test_id", F.when(F.col("_own_n") == 1, F.col("_own_mix")).alias("mix"), F.when(F.col("_ref_n") == 1, F.col("_ref_mix")).alias("reference"), status.alias("status"))


def project_routes(stages: DataFrame, mixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stages on their mixes, stages without a place) of stages (route, stage, after, scope, scope_ids, method, seconds) and mixes (mix, paper_scope).

    A route applies to all mixes of its scope or to those it names; a stage whose predecessor isn't of its route, a named mix that isn't there, or two
    routes of one mix with different content keep the route from being written.
    """
    before = stages.select(F.col("route").alias("_r"), F.col("stage").alias("_s"))
    linked = stages.join(before, (F.col("route") == F.col("_r")) & (F.col("after") == F.col("_s")), "left")
    broken = linked.where("after IS NOT NULL AND _s IS NULL").select("route").distinct().withColumn("_why", F.lit("BROKEN_CHAIN"))
    routes = stages.groupBy("route").agg(F.first("scope").alias("scope"), F.first("scope_ids").alias("scope_ids"), F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("stage", "after", "method", "seconds"))), {"ignoreNullFields": "false"}).cast("binary"), 256).alias("_content"))
    named = routes.where("scope_ids IS NOT NULL").select("route", "_content", F.explode("scope_ids").alias("mix")).join(mixes.select("mix", F.lit(True).alias("_there")), "mix", "left")
    unknown = named.where("_there IS NULL").select("route").distinct().withColumn("_why", F.lit("UNKNOWN_MIX"))
    wide = routes.where("scope_ids IS NULL").join(mixes.select("mix", F.col("paper_scope").alias("scope")), "scope").select("route", "_content", "mix")
    pairs = named.where("_there").select("route", "_content", "mix").unionByName(wide)
    torn = pairs.groupBy("mix").agg(F.count_distinct("_content").alias("_n")).where("_n > 1").select("mix")
    conflicting = pairs.join(torn, "mix", "left_semi").select("route").distinct().withColumn("_why", F.lit("CONFLICTING_ROUTES"))
    why = broken.unionByName(unknown).unionByName(conflicting).groupBy("route").agg(F.min("_why").alias("reason"))
    bad = stages.join(why, "route")
    good = pairs.join(why, "route", "left_anti").groupBy("mix").agg(F.min("route").alias("route"))
    return good.join(stages.select("route", "stage", "after", "method", "seconds"), "route"), bad


def consume_designs(requests: DataFrame, responses: DataFrame, mixes: DataFrame) -> DataFrame:
    """`requests` (design, request_sha256, paper) with outcome and what the design's answer writes: one row per written relation, or one with the reason.

    responses: design, request_sha256, status, relations array<struct(mix, role, target, quote)>. An answer counts only for the request whose hash it names; every
    relation needs a mix of the paper, a target mix of the paper other than itself, a quote, and one target per mix and role.
    """
    one = responses.groupBy("design").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("request_sha256", "status", "relations")).alias("_a"))
    met = requests.join(one, "design", "left")
    early = first_reason((F.col("_n").isNull(), "NO_RESPONSE"), (F.col("_n") > 1, "AMBIGUOUS_RESPONSE"), (~F.coalesce(F.col("_a.request_sha256") == F.col("request_sha256"), F.lit(False)), "STALE_RESPONSE"), (~F.coalesce(F.col("_a.status") == "COMPLETE", F.lit(False)), "INCOMPLETE_RESPONSE"))
    rows = met.withColumn("_early", early).select(*requests.columns, "_early", F.explode_outer(F.when(early.isNull(), F.col("_a.relations"))).alias("_r")).select(*requests.columns, "_early", "_r.*")
    known = lambda name: mixes.select(F.col("mix").alias(f"_{name}"), F.col("paper").alias(f"_{name}_paper"))
    rows = rows.join(known("m"), F.col("mix") == F.col("_m"), "left").join(known("t"), F.col("target") == F.col("_t"), "left")
    targets = F.size(F.collect_set("target").over(Window.partitionBy("design", "mix", "role")))
    reason = F.coalesce("_early", first_reason(
        (F.col("mix").isNull(), "NO_RELATION"), (~F.coalesce(F.col("_m_paper") == F.col("paper"), F.lit(False)), "UNKNOWN_MIX"), (~F.coalesce(F.col("_t_paper") == F.col("paper"), F.lit(False)), "UNKNOWN_TARGET"),
        (F.col("mix") == F.col("target"), "SELF_REFERENCE"), (F.coalesce("quote", F.lit("")) == "", "NO_QUOTE"), (targets > 1, "CONFLICTING_TARGETS"),
    ))
    return rows.select(*requests.columns, "mix", "role", "target", F.coalesce(reason, F.lit("WRITTEN")).alias("outcome"))


def category_rows(charts: DataFrame, chart: str, categories: str, series: str, values: str) -> DataFrame:
    """(chart, series, category, ordinal, value): a chart's parallel lists as rows; lists of different length are a row with the reason."""
    even = F.size(categories) == F.size(values)
    cells = F.when(even, F.zip_with(categories, values, lambda c, v: F.struct(c.alias("category"), v.alias("value"))))
    good = charts.where(even).select(chart, series, F.posexplode(cells).alias("ordinal", "_c")).select(chart, series, "_c.category", "ordinal", "_c.value", F.lit(None).cast("string").alias("reason"))
    kinds = {f.name: f.dataType for f in good.schema.fields}
    bad = charts.where(~F.coalesce(even, F.lit(False))).select(chart, series, *[F.lit(None).cast(kinds[c]).alias(c) for c in ("category", "ordinal", "value")], F.lit("LENGTHS_DIFFER").alias("reason"))
    return good.unionByName(bad)
