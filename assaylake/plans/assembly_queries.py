"""Queries of record assembly and of outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import assembly, outlines
from assaylake.plans.registry import query, table


@query("""
SELECT o_orderkey AS mix, ['DEFERRED:parameter evidence needs association', 'DEFERRED:unit conversion needs association', 'DEFERRED:basis or value unavailable', 'DEFERRED:composite or converted value', 'DEFERRED:material identity needs association', 'DEFERRED:role and unit have no destination',
  'CONFLICT:several existing rows of this identity', 'DEFERRED:equal numbers are no identity', 'CONFLICT:existing value or unit differs', 'DEFERRED:basis equivalence not established', CASE WHEN o_orderkey % 24 = 10 THEN 'reused' ELSE 'rebound' END, 'added'][1 + o_orderkey % 12] AS outcome,
  CASE WHEN o_orderkey % 12 = 10 THEN 0 WHEN o_orderkey % 12 = 11 THEN CASE WHEN o_orderkey % 24 = 11 THEN 0 ELSE 3 END END AS row_index
FROM orders
""")
def source_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as source parameters of mixes of their own, one for each outcome."""
    case, value = F.col("o_orderkey") % 12, F.floor("o_totalprice").cast("double")
    said = lambda n, other, usual: F.when(case == n, other).otherwise(usual)
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("mix"), F.lit("p").alias("paper"), F.lit(0).alias("place"), F.lit("Sand (kg)").alias("label"), said(5, "other", "solid_fraction").alias("role"), F.lit("kg").alias("unit"), said(1, "g", "kg").alias("original_unit"), F.lit("kg").alias("provenance_unit"),
        value.alias("value"), said(3, "3+4", value.cast("string")).alias("original_value"), said(2, F.lit(None).cast("string"), F.lit("sand divided by  binder")).alias("basis"), said(4, "m9", "m1").alias("mat"), F.lit("e1").alias("evidence"), (case != 0).alias("evidence_bound"), F.lit(None).cast("string").alias("cell"),
    )
    mats = spark.createDataFrame([("m1", "p"), ("m9", "other")], "mat string, paper string")
    old = rows.withColumn("case", F.col("mix") % 12).where("case BETWEEN 6 AND 10 OR mix % 24 = 23")
    held = old.select(
        "mix", F.lit("solid_materials").alias("destination"), F.explode(F.when(F.col("case") == 6, F.array(F.lit(0), F.lit(1))).when(F.col("case") == 11, F.array(F.lit(2))).otherwise(F.array(F.lit(0))).cast("array<long>")).alias("row_index"),
        F.when(F.col("case").isin(7, 11), "other").otherwise("SAND").alias("name"), F.lit("m1").alias("mat"), F.when(F.col("case").isin(8, 11), F.col("value") + 1).otherwise(F.col("value")).alias("value"), F.lit("kg").alias("unit"),
        F.when(F.col("case") == 9, "sand/water").otherwise("Sand / binder").alias("basis"), F.when(F.col("mix") % 24 == 10, "ev-source-e1").otherwise("old").alias("evidence"), F.lit(None).cast("string").alias("cell"),
    )
    return assembly.project_parameters(rows, mats, held).select("mix", "outcome", "row_index")


@query("""
WITH i AS (SELECT DISTINCT l_orderkey AS figure, l_linenumber AS series, l_returnflag AS specimen FROM lineitem)
SELECT figure, series, specimen, CASE WHEN series % 4 = 1 AND specimen <> 'A' THEN figure * 10 + 1 WHEN series % 4 = 2 THEN figure * 10 + 2 WHEN series % 4 = 3 AND specimen = 'N' THEN figure * 10 + 3 END AS mix,
  CASE WHEN series % 4 = 0 OR (series % 4 = 1 AND specimen = 'A') THEN 'UNASSIGNED' WHEN series % 4 = 3 AND specimen <> 'N' THEN 'AMBIGUOUS_OWNER' END AS reason FROM i
""")
def chart_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("figure"), F.col("l_linenumber").alias("series"), F.col("l_returnflag").alias("specimen")).distinct()
    heads = items.select("figure", "series").distinct().withColumn("k", F.col("series") % 4)
    none = F.lit(None).cast("string")
    owner = lambda n, specimen, shift=0: heads.where(f"k = {n}").select("figure", "series", specimen.alias("specimen"), (F.col("figure") * 10 + n + shift).alias("mix"))
    owners = owner(1, F.lit("N")).unionByName(owner(1, F.lit("R"))).unionByName(owner(2, none)).unionByName(owner(3, none, 4)).unionByName(owner(3, none, 5)).unionByName(owner(3, F.lit("N")))
    placed, stayed = assembly.chart_items(items, owners)
    return placed.withColumn("reason", F.lit(None).cast("string")).unionByName(stayed.withColumn("mix", F.lit(None).cast("long")))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS figure, CASE WHEN o_orderkey % 9 NOT IN (0, 5) THEN 1 END AS n_mix, CASE WHEN o_orderkey % 9 = 7 THEN 1 ELSE 0 END AS n_reference,
  ['NO_ASSIGNMENT', 'AMBIGUOUS_AXIS_VALUE', 'SPECIMEN_UNRESOLVED', 'SOURCE_SPAN_MISSING', 'AXIS_VALUE_NOT_PRINTED', 'OBSERVATION_UNBOUND', 'REFERENCE_UNBOUND', 'RESOLVED', 'RESOLVED'][1 + o_orderkey % 9] AS status FROM orders
""".replace("CASE WHEN o_orderkey % 9 NOT IN (0, 5) THEN 1 END AS n_mix", "CASE WHEN o_orderkey % 9 NOT IN (0, 2, 5) THEN 1 ELSE 0 END AS n_mix"))
def formulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as figures of one point each, one for each outcome."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("figure"), (F.col("o_orderkey") % 9).alias("k"), (F.col("o_custkey") % 40).cast("double").alias("x"))
    number = F.col("x").cast("int").cast("string")
    made = rows.where("k != 0").select("figure", "k", "x", F.concat(F.lit("T"), "figure").alias("test_id"), F.when(F.col("k") == 6, "gone").when(F.col("k") == 7, F.concat(F.lit("R"), "figure")).alias("reference_id"), F.array(F.when(F.col("k") == 2, "glass").otherwise("paste")).alias("specimens"), F.array(F.when(F.col("k") == 3, "lost").otherwise(F.concat(F.lit("s"), "figure"))).alias("span_ids"), F.array(F.when(F.col("k") == 4, "many").otherwise(F.concat(F.lit("("), number, F.lit("%)")))).alias("tokens"))
    assignments = made.unionByName(made.where("k = 1")).drop("k")
    spans = rows.select(F.concat(F.lit("s"), "figure").alias("span_id"), F.concat(F.lit("many mixes had ("), number, F.lit("%) of it")).alias("text"))
    mixes = made.where("k != 5").select(F.concat(F.lit("m"), "figure").alias("mix"), "test_id", F.lit("paste").alias("specimen")).unionByName(made.where("k = 7").select(F.concat(F.lit("r"), "figure").alias("mix"), F.col("reference_id").alias("test_id"), F.lit("paste").alias("specimen")))
    got = assembly.resolve_formulations(rows.select("figure", "x"), assignments, mixes, spans)
    return got.select("figure", F.col("mix").isNotNull().cast("int").alias("n_mix"), F.col("reference").isNotNull().cast("int").alias("n_reference"), "status")


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS f FROM customer)
SELECT 'm' || k AS mix, 'r' || k AS route, stage, NULL AS reason FROM c, (VALUES ('a'), ('b')) AS s(stage) WHERE f IN (0, 4)
UNION ALL SELECT 'n' || k, 'r' || k, stage, NULL FROM c, (VALUES ('a'), ('b')) AS s(stage) WHERE f = 4
UNION ALL SELECT NULL, 'r' || k, stage, ['BROKEN_CHAIN', 'UNKNOWN_MIX', 'CONFLICTING_ROUTES'][f] FROM c, (VALUES ('a'), ('b')) AS s(stage) WHERE f IN (1, 2, 3)
UNION ALL SELECT NULL, 'q' || k, 'a', 'CONFLICTING_ROUTES' FROM c WHERE f = 3
""")
def production_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as routes of two stages: named, broken, of an unknown mix, torn between two routes, and by scope."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"), (F.col("c_custkey") % 5).alias("f"))
    name, none = lambda p: F.concat(F.lit(p), "k"), F.lit(None).cast("string")
    ids = F.when(F.col("f") == 2, F.array(name("gone"))).when(F.col("f") != 4, F.array(name("m")))
    stage = lambda s, after: rows.select(name("r").alias("route"), F.lit(s).alias("stage"), after.alias("after"), name("scope").alias("scope"), ids.alias("scope_ids"), F.lit("cure").alias("method"), F.lit(60.0).alias("seconds"))
    other = rows.where("f = 3").select(name("q").alias("route"), F.lit("a").alias("stage"), none.alias("after"), name("scope").alias("scope"), F.array(name("m")).alias("scope_ids"), F.lit("steam").alias("method"), F.lit(90.0).alias("seconds"))
    stages = stage("a", none).unionByName(stage("b", F.when(F.col("f") == 1, "z").otherwise("a"))).unionByName(other)
    mixes = rows.select(name("m").alias("mix"), name("scope").alias("paper_scope")).unionByName(rows.where("f = 4").select(name("n").alias("mix"), name("scope").alias("paper_scope")))
    good, bad = assembly.project_routes(stages, mixes)
    return good.select("mix", "route", "stage", none.alias("reason")).unionByName(bad.select(none.alias("mix"), "route", "stage", "reason"))


@query("""
SELECT o_orderkey AS design, ['NO_RESPONSE', 'STALE_RESPONSE', 'INCOMPLETE_RESPONSE', 'NO_RELATION', 'UNKNOWN_MIX', 'UNKNOWN_TARGET', 'SELF_REFERENCE', 'NO_QUOTE', 'WRITTEN', 'CONFLICTING_TARGETS', 'AMBIGUOUS_RESPONSE'][1 + o_orderkey % 11] AS outcome, CASE WHEN o_orderkey % 11 = 9 THEN 2 ELSE 1 END AS n FROM orders
""")
def designs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as designs with an answer each, one for each outcome."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("design"), (F.col("o_orderkey") % 11).alias("k"))
    k = F.col("k")
    relation = lambda target: F.struct(F.when(k == 4, "zz").otherwise("a").alias("mix"), F.lit("control").alias("role"), target.alias("target"), F.when(k == 7, "").otherwise("q").alias("quote"))
    relations = F.when(k == 3, F.array().cast("array<struct<mix: string, role: string, target: string, quote: string>>")).when(k == 9, F.array(relation(F.lit("b")), relation(F.lit("c")))).otherwise(F.array(relation(F.when(k == 5, "zz").when(k == 6, "a").otherwise("b"))))
    answers = rows.where("k != 0").select("design", F.when(k == 1, "old").otherwise("h").alias("request_sha256"), F.when(k == 2, "OPEN").otherwise("COMPLETE").alias("status"), relations.alias("relations"))
    mixes = spark.createDataFrame([(m, "p") for m in "abc"] + [("zz", "other")], "mix string, paper string")
    requests = rows.select("design", F.lit("h").alias("request_sha256"), F.lit("p").alias("paper"))
    got = assembly.consume_designs(requests, answers.unionByName(answers.where("design % 11 = 10")), mixes)
    return got.groupBy("design", "outcome").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("""
WITH s AS (SELECT p_partkey, unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS part, p_size + 1.0 AS w FROM part)
SELECT p_partkey AS path, 'ELONGATED' AS status, CAST(part AS DOUBLE) AS part, round(CAST(p_partkey + part * w AS DOUBLE), 6) AS x, CAST(10.25 AS DOUBLE) AS y, CAST(0.5 AS DOUBLE) AS width FROM s
""")
def outline_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as flat closed outlines of their size."""
    x0, x1 = F.col("p_partkey").cast("double"), F.col("p_partkey") + F.col("p_size") + 1.0
    corners = [(x0, F.lit(10.0)), (x1, F.lit(10.0)), (x1, F.lit(10.5)), (x0, F.lit(10.5))]
    sides = F.array(*[F.struct(F.lit(i).alias("item"), F.lit("l").alias("kind"), a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")) for i, (a, b) in enumerate(zip(corners, [*corners[1:], corners[0]], strict=True))])
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path"), F.explode(sides).alias("s")).select("path", "s.*")
    return outlines.center_sections(outlines.split_subpaths(items)).select("path", "status", "part", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("width", 6).alias("width"))
