"""Queries of review pairing, evidence, run checks, journals and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import claims, composition, control, evidence, merging, ranking, review, run_checks, scoring
from assaylake.plans.registry import query, table


@query("""
WITH l AS (SELECT s_suppkey % 500 AS record, s_suppkey AS id, ['slag', 'flyash', 'portlandcement', 'sand' || s_suppkey % 7][1 + s_suppkey % 4] AS k FROM supplier),
r AS (SELECT c_custkey % 500 AS record, c_custkey AS id, ['slag', 'flyash', 'portlandcement', 'sand' || c_custkey % 7][1 + c_custkey % 4] AS k, c_acctbal > 0 AS keep FROM customer),
one AS (SELECT record, k, min(id) AS rid FROM r GROUP BY record, k HAVING count(*) = 1),
p AS (SELECT l.record, l.id AS left_id, one.rid AS right_id FROM (SELECT *, row_number() OVER (PARTITION BY record, k ORDER BY id) AS turn FROM l) l LEFT JOIN one ON l.record = one.record AND l.k = one.k AND l.turn = 1)
SELECT * FROM p UNION ALL SELECT record, NULL, id FROM r WHERE keep AND NOT EXISTS (SELECT 1 FROM p WHERE p.record = r.record AND p.right_id = r.id)
""")
def material_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_names, right_names = ("GGBS", "Class F fly-ash", "PC", "Sand %s"), ("Ground granulated blast furnace slag", "FA", "Portland Cement", "sand-%s")
    named = lambda names, key: F.array(*[F.format_string(n, (F.col(key) % 7).cast("string")) if "%s" in n else F.lit(n) for n in names])[(F.col(key) % 4).cast("int")]
    left = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 500).alias("record"), F.col("s_suppkey").alias("l"), named(left_names, "s_suppkey").alias("name"))
    right = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 500).alias("record"), F.col("c_custkey").alias("r"), named(right_names, "c_custkey").alias("name"), "c_acctbal")
    return review.pair_materials(left, right, "record", "l", "r", "name", F.col("c_acctbal") > 0)


@query("""
WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS n FROM conversations),
m AS (SELECT conv_id, turn, turn % 7 <> 6 AS has_right, turn % 5 = 4 AS no_value, turn % 3 = 2 AS differs FROM t)
SELECT conv_id, turn AS left_order, CASE WHEN has_right AND (no_value OR NOT differs) THEN turn END AS right_order, CASE WHEN has_right AND NOT no_value AND differs THEN 'CONFLICT' END AS error FROM m
UNION ALL SELECT conv_id, NULL, turn, NULL FROM m WHERE has_right AND NOT no_value AND differs
""")
def parameter_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), F.length(F.coalesce("text", F.lit(""))).cast("double").alias("n"), F.lit("mass %").alias("unit"))
    left = rows.select("conv_id", "turn", F.format_string("Parameter (%s)", F.col("turn").cast("string")).alias("label"), F.when(F.col("turn") % 5 != 4, F.col("n")).alias("n"), "unit")
    right = rows.where("turn % 7 != 6").select("conv_id", "turn", F.format_string("derived parameter_%s", F.col("turn").cast("string")).alias("label"), (F.col("n") + F.when(F.col("turn") % 3 == 2, 1).otherwise(0)).alias("n"), "unit")
    return review.pair_parameters(left, right, "conv_id", "turn", "label", "n", "unit")


@query("""
SELECT o_custkey AS paper, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS left_mix, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS right_mix,
  CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 THEN ['ANCHOR', 'IDENTITY', 'OVERLAP'][1 + o_orderkey % 3] END AS tier, CAST(NULL AS VARCHAR) AS error
FROM orders WHERE o_orderkey % 143 <> 0
""")
def mix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the mixes of a customer, in two layers: a third agree on a table's row, a third on their identity, a third on its beginning and a value."""
    kind, key = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    items = F.array(F.struct(F.lit("water to binder").alias("label"), F.col("o_orderkey").cast("double").cast("string").alias("value"), F.lit("").alias("unit")))
    side = lambda name: table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("paper"), F.col("o_orderkey").alias("mix"), name.alias("identity"), F.when(kind == 0, "Table 1").alias("source_table"), F.when(kind == 0, F.col("o_orderkey")).alias("source_row"), items.alias("items"), F.lit(False).alias("bare"))
    left = side(F.concat(F.lit("Mix "), key, F.lit("-A"))).where("mix % 13 != 0")
    right = side(F.concat(F.when(kind == 0, "other").otherwise("mix"), key, F.lit("a"), F.when(kind == 2, "28").otherwise(""))).where("mix % 11 != 0")
    return review.pair_mixes(left, right, "paper", "mix")


LOCATE_BLOCKS = """
WITH b AS (SELECT conv_id, turn, replace(regexp_replace(lower(coalesce(text, '')), '\\s+|­', '', 'g'), 'ß', 'ss') AS t FROM conversations),
o AS (SELECT conv_id, turn, t, lead(t) OVER w AS next, sum(length(t)) OVER w AS hi FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
j AS (SELECT conv_id, string_agg(t, '' ORDER BY turn) AS joined FROM b GROUP BY conv_id),
r AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN left(t, 30) ELSE right(t, 15) || left(next, 15) END AS q FROM o WHERE length(t) >= 40 AND (turn % 2 = 0 OR length(next) >= 40)),
p AS (SELECT r.*, instr(j.joined, r.q) AS at FROM r JOIN j USING (conv_id))
SELECT CAST(p.conv_id AS VARCHAR) AS document, CAST(p.turn AS VARCHAR) AS ref, CASE WHEN p.turn % 4 = 0 THEN 'block' ELSE 'document' END AS tier,
  CASE WHEN p.turn % 4 = 0 THEN CAST(p.turn AS VARCHAR) ELSE CAST((SELECT min(o.turn) FROM o WHERE o.conv_id = p.conv_id AND o.hi >= p.at) AS VARCHAR) END AS block
FROM p
"""


@query(LOCATE_BLOCKS)
def evidence_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as a document's blocks, one a page; quotes from within a turn, cited rightly or not at all, and quotes across two turns."""
    from pyspark.sql import Window

    plain = F.replace(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "\\s+|­", ""), F.lit("ß"), F.lit("ss"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", plain.alias("t")).withColumn("next", F.lead("t").over(Window.partitionBy("conv_id").orderBy("turn")))
    even, none = F.col("turn") % 2 == 0, F.lit(None).cast("double")
    quote = F.when(even, F.left("t", F.lit(30))).otherwise(F.concat(F.right("t", F.lit(15)), F.left("next", F.lit(15))))
    refs = rows.where((F.length("t") >= 40) & (even | (F.length("next") >= 40))).select(F.col("conv_id").alias("document"), F.col("turn").alias("ref"), F.when(F.col("turn") % 4 == 0, F.col("turn").cast("string")).otherwise("nowhere").alias("cited"), quote.alias("quote"), F.lit(None).cast("string").alias("token"))
    blocks = rows.select(F.col("conv_id").alias("document"), F.col("turn").alias("block"), (F.col("turn") + 1).alias("page"), none.alias("x0"), none.alias("y0"), none.alias("x1"), none.alias("y1"), "text")
    return evidence.locate(refs, blocks).select("document", "ref", "tier", "block")


RUN_CHECKS = """
WITH d(name, n) AS (
  SELECT * FROM (VALUES ('manifest_exists', 0), ('control_state_exists', 0), ('claims_exists', 0), ('records_exists', 0), ('sqlite_exists', 0), ('platform_contract', 0), ('claims_hash', 1), ('records_hash', 0), ('sqlite_integrity', 0), ('sqlite_foreign_keys', 0), ('sqlite_readable', 0),
    ('control_sqlite_integrity', 0), ('control_sqlite_foreign_keys', 1), ('control_sqlite_readable', 0), ('snapshot_manifest_exists', 0), ('snapshot_manifest_hash', 0), ('claim_assembly_roundtrip', 0), ('has_mat', 0), ('has_mix', 0), ('unique_paper_keys', 0), ('source_integrity', 0), ('record_version_persisted', 1))
  UNION ALL SELECT 'has_one_paper', CASE WHEN count(*) = 1 THEN 0 ELSE 1 END FROM region
  UNION ALL SELECT 'unique_mat_keys', count(*) FROM (SELECT s_nationkey % 20 * 1000 + s_suppkey FROM supplier GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'mat_paper_references', count(*) FROM supplier WHERE s_nationkey % 7 > 4
  UNION ALL SELECT 'mix_paper_references', count(*) FROM customer WHERE c_nationkey % 9 > 4
  UNION ALL SELECT 'mix_mat_references', count(*) FROM orders WHERE o_orderkey % 97 NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'field_provenance', count(*) FROM customer WHERE c_custkey % 5 IN (0, 1, 2, 3)
  UNION ALL SELECT 'asset_links_and_hashes', (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0 AND c_nationkey > 20) + (SELECT count(*) FROM nation WHERE n_nationkey <= 20 AND n_nationkey % 4 IN (0, 1))
  UNION ALL SELECT 'no_unconfirmed_blocking_candidates', count(*) FROM labels WHERE toxic = 1 AND quality = 0
  UNION ALL SELECT 'xrf_total_gate', count(*) FROM supplier WHERE s_suppkey % 120 > 100 AND s_suppkey % 2 = 0
  UNION ALL SELECT 'unit_conversion_roundtrip', count(*) FROM supplier WHERE s_suppkey % 10 = 3
  UNION ALL SELECT 'claims_persisted', CASE WHEN (SELECT count(*) FROM customer) = (SELECT count(*) FROM orders) THEN 0 ELSE 1 END
  UNION ALL SELECT 'issues_persisted_once', 0
)
SELECT name AS "check", CAST(n AS BIGINT) AS defects, CASE WHEN n = 0 THEN 'PASS' ELSE 'REJECT' END AS verdict, (SELECT sha256(string_agg(name, ',' ORDER BY name)) FROM d WHERE n > 0) AS fingerprint FROM d
"""


@query(RUN_CHECKS)
def validation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All named checks of a run, with the tables as its records."""
    get = lambda name: table(spark, sf_dir, name)
    measured = spark.createDataFrame([(n, n not in ("claims_hash", "control_sqlite_foreign_keys")) for n in run_checks.MEASURED], "name string, passed boolean")
    supplier, customer, orders, nation, labels = (get(n) for n in ("supplier", "customer", "orders", "nation", "labels"))
    surface = F.col("s_suppkey").cast("double")
    key, fifth = F.col("c_custkey").cast("string"), F.col("c_custkey") % 5
    claims = customer.select(key.alias("record_key"), F.lit("/name").alias("field_path"), F.col("c_name").alias("value"))
    tables = {
        "papers": get("region").select(F.col("r_regionkey").alias("paper_key")),
        "mats": supplier.select(F.col("s_suppkey").alias("mat_key"), (F.col("s_nationkey") % 7).alias("paper_key"), (F.col("s_suppkey") % 120).alias("original_total"), (F.col("s_suppkey") % 2 == 1).alias("normalised"), surface.alias("original_value"), (surface * 0.1 + F.when(F.col("s_suppkey") % 10 == 3, 0.01).otherwise(0)).alias("specific_surface")),
        "mixes": customer.select(F.col("c_custkey").alias("mix_key"), (F.col("c_nationkey") % 9).alias("paper_key")),
        "mat_refs": orders.select("o_orderkey", (F.col("o_orderkey") % 97).alias("mat_key")),
        "required": customer.select(key.alias("record_key"), F.lit("/name").alias("field_path")),
        "provenance": customer.where(fifth != 1).select(key.alias("record_key"), F.lit("/name").alias("field_path"), F.col("c_custkey").alias("evidence_key")),
        "evidence": customer.where(fifth != 0).select(F.col("c_custkey").alias("evidence_key"), F.when(fifth == 2, "other").otherwise(key).alias("evidence_record"), F.when(fifth == 3, 0).otherwise(1).alias("page"), F.col("c_nationkey").alias("asset_key")),
        "assets": nation.where("n_nationkey <= 20").select(F.col("n_nationkey").alias("asset_key"), F.col("n_name").alias("path"), F.lit("h").alias("sha256")),
        "files": nation.where("n_nationkey % 4 != 0").select(F.col("n_name").alias("path"), F.when(F.col("n_nationkey") % 4 == 1, "x").otherwise("h").alias("sha256")),
        "candidates": labels.select(F.when(F.col("quality") == 1, "confirmed").alias("status"), (F.col("toxic") == 1).alias("blocks_record"), F.lit("r").alias("reason")),
        "claims": claims, "assembled": claims, "records": claims, "stored_claims": orders, "stored_issues": labels, "versions": labels.limit(2),
    }
    return run_checks.run_checks(measured, tables)


@query("""
WITH e AS (SELECT user_id, event_id, ts, ['OBSERVED', 'RESOLVED', 'VERIFIED', 'REOPENED'][1 + CAST(json_extract_string(props, '$.k') AS INT) % 4] AS st, event_type, CASE WHEN value > 80 THEN 'c' || event_id ELSE '' END AS fix, CASE WHEN value < 3 THEN 'v' || event_id END AS ver, ['p' || event_id % 5, 'q' || event_id % 3] AS paths FROM events),
p AS (SELECT user_id, list_sort(list_distinct(flatten(list(paths)))) AS paths FROM e GROUP BY user_id)
SELECT e.user_id, arg_min(event_type, (ts, event_id)) AS kind, arg_max(st, (ts, event_id)) AS latest_status, count(*) AS n_events, arg_max(fix, (ts, event_id)) FILTER (WHERE fix <> '') AS fix, arg_max(ver, (ts, event_id)) FILTER (WHERE ver IS NOT NULL) AS verification,
  array_to_string(any_value(p.paths), ',') AS evidence_paths, arg_max(st, (ts, event_id)) NOT IN ('RESOLVED', 'VERIFIED', 'EXERCISED') AS open
FROM e JOIN p ON e.user_id = p.user_id GROUP BY e.user_id
""")
def fault_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int") % 4
    status = F.array(*map(F.lit, ("OBSERVED", "RESOLVED", "VERIFIED", "REOPENED")))[k]
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", status.alias("status"), F.col("event_type").alias("kind"), F.when(F.col("value") > 80, F.concat(F.lit("c"), "event_id")).otherwise("").alias("fix"),
        F.when(F.col("value") < 3, F.concat(F.lit("v"), "event_id")).alias("verification"), F.array(F.concat(F.lit("p"), F.col("event_id") % 5), F.concat(F.lit("q"), F.col("event_id") % 3)).alias("paths"),
    )
    got = control.fault_report(rows, "user_id", ["ts", "event_id"], "status", "fix", "verification", "paths", ["kind"], [])
    return got.select("user_id", "kind", "latest_status", "n_events", "fix", "verification", F.array_join("evidence_paths", ",").alias("evidence_paths"), "open")


@query("""
SELECT o_orderkey AS probe, CASE WHEN o_orderkey % 6 = 0 THEN 'START' WHEN o_orderkey % 6 = 1 THEN 'ADOPT' ELSE 'BLOCKED_UNCERTAIN_PROBE' END AS decision FROM orders
""")
def journal_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as probes: untouched, proven, of another binding, with another result, only reserved, or with a result alone."""
    kind, rows = F.col("o_orderkey") % 6, table(spark, sf_dir, "orders")
    probe, binding = F.col("o_orderkey").alias("probe"), F.col("o_custkey").cast("string").alias("binding")
    sha = F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256)
    done = rows.where(kind.isin(1, 2, 3)).select(probe, F.lit("COMPLETED").alias("status"), F.when(kind == 2, "x").otherwise(F.col("o_custkey").cast("string")).alias("binding"), sha.alias("result_sha256"))
    results = rows.where(kind.isin(1, 2, 3, 5)).select(probe, F.when(kind == 3, "other").otherwise(sha).alias("sha256"))
    return control.journal_decisions(rows.select(probe, binding), rows.where(kind.isin(1, 2, 3, 4)).select(probe), done, results).select("probe", "decision")


@query("""
WITH c AS (SELECT c_custkey AS run, c_custkey % 8 AS n, c_custkey % 5 AS fault FROM customer)
SELECT run, CASE WHEN (n >= 3 AND fault IN (1, 2)) THEN NULL ELSE ['PREPARED', 'METADATA_CACHED', 'ARMS_FROZEN', 'PROBED', 'SUMMARIZED', 'REPLAYED', 'VERIFIED'][n + 1] END AS next_step,
  CASE WHEN n >= 3 AND fault = 1 THEN 'MISSING_STEP' WHEN n >= 3 AND fault = 2 THEN 'REPLAY_DIFFERS:METADATA_CACHED' END AS error FROM c
""")
def controller_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs of zero to seven steps, some without their second step, some with another result of it."""
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run"), (F.col("c_custkey") % 8).alias("n"), (F.col("c_custkey") % 5).alias("fault"))
    steps = runs.where("n > 0").select("run", "n", "fault", F.posexplode(F.slice(F.array(*map(F.lit, control.ARM_STEPS)), F.lit(1), F.col("n").cast("int"))).alias("at", "step")).withColumn("artifact_sha256", F.concat_ws("-", "run", "step"))
    kept = steps.where("NOT (n >= 3 AND fault = 1 AND at = 1)")
    now = steps.withColumn("artifact_sha256", F.when(F.expr("n >= 3 AND fault = 2 AND at = 1"), "other").otherwise(F.col("artifact_sha256")))
    return control.controller_states(runs.select("run"), kept.select("run", "step", "artifact_sha256"), now.select("run", "step", "artifact_sha256"))


@query("""
WITH t AS (SELECT conv_id, count(*) FILTER (WHERE conv_id % 4 <> 3) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN conv_id % 4 = 3 THEN 'GONE' WHEN conv_id % 4 = 2 THEN 'CHANGED' ELSE 'VALID' END AS verdict, CASE WHEN conv_id % 4 = 3 THEN 'VOID' WHEN conv_id % 4 = 2 THEN CASE WHEN conv_id % 8 = 2 THEN 'REBOUND' ELSE 'VOID' END ELSE 'KEPT' END AS state FROM t
""")
def seal_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"))
    seals = control.sealed(rows, "conv_id", "turn", "digest")
    later = rows.where("conv_id % 4 != 3").withColumn("digest", F.when((F.col("conv_id") % 4 == 2) & (F.col("turn") == 0), "new").otherwise(F.col("digest")))
    verdicts = control.verify_seals(seals.select("conv_id", "seal"), later, "conv_id", "turn", "digest")
    states = control.rebound(seals.select("conv_id", "seal"), control.sealed(later, "conv_id", "turn", "digest"), "conv_id", rows.where("conv_id % 8 = 2").select("conv_id"))
    return verdicts.select("conv_id", "verdict").join(states.select("conv_id", "state"), "conv_id")


@query("""
WITH f AS (SELECT o_custkey, o_orderpriority, count(DISTINCT o_orderkey) AS n, min('r' || o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o.o_orderkey, CASE WHEN f.n = 1 THEN f.r END AS response, CASE WHEN f.n IS NULL THEN 'RUN' WHEN f.n = 1 THEN 'REUSE' ELSE 'AMBIGUOUS' END AS action FROM orders o LEFT JOIN f ON o.o_custkey = f.o_custkey AND o.o_orderpriority = f.o_orderpriority
""")
def response_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    signature = control.source_signature(F.col("o_custkey").cast("string"), F.array(F.lit(2), F.lit(1)), F.lit("v1"), F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", signature.alias("signature"), "o_orderstatus")
    cache = rows.select("signature", F.concat(F.lit("r"), "o_orderkey").alias("response"), F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("OPEN").alias("status"))
    return control.reusable_responses(rows.select("o_orderkey", "signature"), cache).select("o_orderkey", "response", "action")


@query("SELECT conv_id * 1000 + turn AS task, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS level FROM conversations")
def task_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn waits for the turn before it."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("task"))
    edges = rows.withColumn("before", F.lag("task").over(Window.partitionBy("conv_id").orderBy("turn"))).where("before IS NOT NULL").select("before", F.col("task").alias("after"))
    return control.levels(edges, rows, "task", "before", "after")


@query("""
WITH a AS (SELECT s_suppkey AS record, '/a/x' AS path, s_nationkey AS v FROM supplier UNION ALL SELECT s_suppkey, '/a/y/0', CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END FROM supplier UNION ALL SELECT s_suppkey, '/b', s_suppkey FROM supplier),
b AS (SELECT c_custkey AS record, '/a/x' AS path, c_nationkey AS v FROM customer UNION ALL SELECT c_custkey, '/a/y/0', c_custkey FROM customer UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '/b/c' ELSE '/b' END, c_custkey FROM customer),
m AS (SELECT coalesce(a.record, b.record) AS record, coalesce(a.path, b.path) AS path, a.v AS av, b.v AS bv FROM a FULL JOIN b ON a.record = b.record AND a.path = b.path),
c AS (SELECT *, (av IS NOT NULL AND bv IS NOT NULL AND av <> bv) OR (path IN ('/b', '/b/c') AND record % 4 = 0 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = record) AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = record)) AS clash FROM m)
SELECT record, path, CASE WHEN NOT clash THEN CAST(coalesce(av, bv) AS VARCHAR) END AS v, CASE WHEN clash THEN 'CONFLICT' WHEN av IS NULL AND bv IS NOT NULL THEN 'FILLED' ELSE 'KEPT' END AS status FROM c
""")
def leaf_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    def leaves(name: str, key: str, nation: str, third, last) -> DataFrame:
        cells = F.array(*[F.struct(p.alias("path"), v.cast("string").alias("v")) for p, v in ((F.lit("/a/x"), F.col(nation)), (F.lit("/a/y/0"), third), (last, F.col(key)))])
        return table(spark, sf_dir, name).select(F.col(key).alias("record"), F.explode(cells).alias("c")).select("record", "c.*", F.lit("number").alias("kind"))

    left = leaves("supplier", "s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey")), F.lit("/b"))
    right = leaves("customer", "c_custkey", "c_nationkey", F.col("c_custkey"), F.when(F.col("c_custkey") % 4 == 0, "/b/c").otherwise("/b"))
    return merging.fill_leaves(left, right, "record", "path", "v", "kind").drop("kind")


@query("""
WITH w AS (SELECT l_partkey AS k, count(DISTINCT l_quantity) AS n, min(l_quantity) AS q FROM lineitem WHERE l_linenumber = 1 GROUP BY 1),
t AS (SELECT p_partkey AS k, CAST(p_size AS DOUBLE) AS v, CASE WHEN p_partkey % 5 = 0 THEN 'g' ELSE 'kg' END AS u FROM part WHERE p_partkey % 2 = 0)
SELECT w.k, CASE WHEN n > 1 THEN 'WRITES_DIFFER' WHEN t.k IS NOT NULL AND u <> 'kg' THEN 'UNIT_CONFLICT' WHEN t.k IS NOT NULL AND v <> q THEN 'VALUE_CONFLICT' END AS defect FROM w LEFT JOIN t ON w.k = t.k WHERE n > 1 OR (t.k IS NOT NULL AND (u <> 'kg' OR v <> q))
""")
def write_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("double").alias("v"), F.when(F.col("p_partkey") % 5 == 0, "g").otherwise("kg").alias("u"))
    writes = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("double").alias("v"), F.lit("kg").alias("u"))
    return merging.staged_writes(old, writes, "k", "v", "u")[1]


@query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, CASE arg_max(event_type, (ts, event_id)) WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS rank FROM events GROUP BY user_id
""")
def last_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("arrival"))
    return merging.last_wins(rows, "user_id", "arrival", {"purchase": 0, "view": 1}, "event_type").select("user_id", "event_type", "rank")


VERDICTS = """
WITH m AS (SELECT n_nationkey AS region, s_suppkey, s_acctbal, s_suppkey % 3 AS arm FROM supplier JOIN nation ON s_nationkey = n_nationkey),
a AS (SELECT arm, count(*) AS n, avg(s_acctbal) AS mean_score, count(DISTINCT region) AS n_hosts, count(*) FILTER (WHERE s_acctbal > 1000 - 600 * arm) AS n_good, count(*) FILTER (WHERE s_suppkey % 2 = 0) AS n_matched, CAST(2 AS BIGINT) AS n_strata FROM m GROUP BY arm),
x AS (SELECT max(CASE WHEN arm = 0 THEN n_good / n END) AS share_a, max(CASE WHEN arm = 2 THEN n_good / n END) AS share_b, max(CASE WHEN arm = 0 THEN mean_score END) - max(CASE WHEN arm = 2 THEN mean_score END) AS mean_drop, max(CASE WHEN arm = 0 THEN n_matched END) - max(CASE WHEN arm = 2 THEN n_matched END) AS lost, min(n_hosts) FILTER (WHERE arm IN (0, 2)) AS hosts FROM a),
c(name, max_drop, least, gain, most_lost, least_hosts, least_strata) AS (VALUES ('loose', 100000.0, 0.75, 0.10, 1000, 1, 1), ('strata', 100000.0, 0.75, 0.10, 1000, 1, 3), ('high', 100000.0, 0.0, 2.0, 1000, 1, 1), ('never', 100000.0, 2.0, 2.0, 1000, 1, 1), ('drop', -100000.0, 0.0, 0.0, 1000, 1, 1))
SELECT name, CASE WHEN mean_drop > max_drop OR lost > most_lost OR hosts < least_hosts OR 2 < least_strata THEN 'INVALID' WHEN share_b >= least AND share_b - share_a >= gain - 1e-12 THEN 'PASS' WHEN share_b >= least OR share_b - share_a >= gain - 1e-12 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict FROM x, c
"""


@query(VERDICTS)
def guarded_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in three arms under five sets of limits: every outcome and guard."""
    arm = F.col("s_suppkey") % 3
    rows = table(spark, sf_dir, "supplier").select(arm.alias("arm"), "s_suppkey", "s_nationkey", "s_acctbal", F.array((F.col("s_suppkey") % 2).cast("string")).alias("strata"))
    both = rows.withColumn("strata", F.array(F.lit("0"), F.lit("1")))
    metrics = scoring.arm_metrics(both, "arm", "s_acctbal", "s_nationkey", F.col("s_acctbal") > 1000 - 600 * F.col("arm"), "strata")
    metrics = metrics.join(rows.groupBy("arm").agg(F.count_if(F.col("s_suppkey") % 2 == 0).alias("n_matched")), "arm")
    limits = {"loose": (1e5, 0.75, 0.10, 1000, 1, 1), "strata": (1e5, 0.75, 0.10, 1000, 1, 3), "high": (1e5, 0.0, 2.0, 1000, 1, 1), "never": (1e5, 2.0, 2.0, 1000, 1, 1), "drop": (-1e5, 0.0, 0.0, 1000, 1, 1)}
    parts = [scoring.two_arm_verdict(metrics, "arm", 0, 2, *limit).select(F.lit(name).alias("name"), "verdict") for name, limit in limits.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


GREEDY = """
WITH RECURSIVE p AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS host, CAST(page_id % 3 AS VARCHAR) AS s1, 't' || page_id % 5 AS s2 FROM pages),
r AS (
  SELECT 0 AS pick, [-1]::BIGINT[] AS ids, ['']::VARCHAR[] AS hosts, ['']::VARCHAR[] AS strata, '' AS stratum
  UNION ALL
  SELECT pick + 1, list_append(ids, c.page_id), list_append(hosts, c.host), list_concat(strata, ADDED), c.stratum FROM (
    SELECT r.pick, r.ids, r.hosts, r.strata, arg_min({'page_id': p.page_id, 'host': p.host, 's1': p.s1, 's2': p.s2, 'stratum': CASE WHEN N2 < N1 THEN p.s2 ELSE p.s1 END}, (len(list_filter(r.hosts, lambda x: x = p.host)), least(N1, N2), p.page_id)) AS c
    FROM r JOIN p ON NOT list_contains(r.ids, p.page_id) WHERE r.pick < 30 GROUP BY r.pick, r.ids, r.hosts, r.strata)
)
SELECT ids[-1] AS page_id, hosts[-1] AS host, CHOSEN CAST(pick AS BIGINT) AS pick FROM r WHERE pick > 0
""".replace("N1", "len(list_filter(r.strata, lambda x: x = p.s1))").replace("N2", "len(list_filter(r.strata, lambda x: x = p.s2))")


def _pool(spark: SparkSession, sf_dir: str, one: bool) -> DataFrame:
    from assaylake.functions import urls

    strata = F.array((F.col("page_id") % 3).cast("string"), F.concat(F.lit("t"), F.col("page_id") % 5))
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"), strata.alias("strata"))
    return ranking.spread_strata(rows, "host", "strata", ["page_id"], 30, one=one, short="error")


@query(GREEDY.replace("ADDED", "[c.s1, c.s2]").replace("CHOSEN", ""))
def diverse_pool_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pool(spark, sf_dir, False).select("page_id", "host", "pick")


@query(GREEDY.replace("ADDED", "[c.stratum]").replace("CHOSEN", "stratum AS selected_stratum,"))
def diverse_pool_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pool(spark, sf_dir, True).select("page_id", "host", "selected_stratum", "pick")


@query("""
WITH p AS (SELECT DISTINCT l_orderkey AS record, l_returnflag AS component, l_linenumber AS item FROM lineitem WHERE l_linenumber % 4 <> 0),
v AS (SELECT l_orderkey AS record, l_returnflag AS component, l_linenumber AS item, bool_or(l_quantity > 25) AS ok FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1, 2, 3),
m AS (SELECT coalesce(p.record, v.record) AS record, coalesce(p.component, v.component) AS component, p.record IS NOT NULL AS planned, v.ok FROM p FULL JOIN v ON p.record = v.record AND p.component = v.component AND p.item = v.item),
g AS (SELECT record, component, count(*) FILTER (WHERE planned) AS n_planned, count(*) FILTER (WHERE planned AND ok IS NOT NULL) AS n_captured, count(*) FILTER (WHERE planned AND ok) AS n_validated, count(*) FILTER (WHERE NOT planned) AS more FROM m GROUP BY 1, 2)
SELECT record, component, n_planned, n_captured, n_validated, CASE WHEN n_planned = 0 OR more > 0 THEN 'UNPLANNED' WHEN n_captured = 0 THEN 'MISSING' WHEN n_validated = n_planned THEN 'VALIDATED' WHEN n_validated > 0 THEN 'PARTIALLY_VALIDATED' ELSE 'CAPTURED' END AS assessment FROM g
""")
def component_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record"), F.col("l_returnflag").alias("component"), F.col("l_linenumber").alias("item"), (F.col("l_quantity") > 25).alias("validated"), "l_suppkey")
    return claims.component_assessment(rows.where("item % 4 != 0"), rows.where("l_suppkey % 3 != 0"))


@query("SELECT (SELECT count(*) FROM customer) AS mixes, (SELECT count(*) FROM supplier) AS mats, (SELECT count(c_mktsegment) + count(c_name) FROM customer) AS table_values, (SELECT count(s_name) FROM supplier) AS mat_names")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = claims.flatten(table(spark, sf_dir, "customer"), "c_custkey", "mixes", ["c_name", "c_mktsegment"]).unionByName(claims.flatten(table(spark, sf_dir, "supplier"), "s_suppkey", "mats", ["s_name"]))
    return claims.run_counters(leaves, {"mixes": ("mixes", ""), "mats": ("mats", ""), "table_values": ("mixes", "/c_"), "mat_names": ("mats", "/s_name")})


@query("SELECT user_id, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS seen, count(*) FILTER (WHERE event_type = 'error') AS errors, round(coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0), 4) AS spent FROM events GROUP BY user_id")
def event_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = claims.event_counters(table(spark, sf_dir, "events"), ["user_id"], "event_type", {"seen": ("click", "view"), "errors": ("error",)}, {"spent": ("purchase", "value")})
    return got.withColumn("spent", F.round("spent", 4))


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DOUBLE) AS share FROM lineitem),
t AS (SELECT *, sum(share) OVER (PARTITION BY l_orderkey) AS total FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(share / 100 * 2000, 6) AS mass, round(CASE WHEN l_linenumber % 3 <> 0 THEN share / 100 * 2000 / (l_linenumber % 3) END, 6) AS volume, abs(total - 100) <= 0.11 AS complete FROM t
""")
def recipe_masses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("double").alias("share"))
    got = composition.masses(parts, "l_orderkey", "share", (F.col("l_linenumber") % 3).cast("double"), F.lit(2000.0))
    return got.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("mass", 6).alias("mass"), F.round("volume", 6).alias("volume"), "complete")


@query("""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)
SELECT conv_id AS paper, count(*) AS n_cards, sum(length(text)) AS n_chars, string_agg(role, ',' ORDER BY turn) AS roles FROM c GROUP BY conv_id
""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("paper"), F.concat_ws("-", "conv_id", "turn").alias("card"), F.col("turn").alias("place"), F.col("role").alias("label"), F.coalesce("text", F.lit("")).alias("value"))
    fields = rows.select("card", F.lit(0).alias("place"), F.lit("text").alias("label"), "value", F.lit("reported").alias("status"))
    got = claims.review_queue(rows.select("paper", F.lit("t").alias("title")).distinct(), rows.select("paper", "card", "place", "label"), fields)
    chars = F.aggregate("cards", F.lit(0), lambda s, c: s + F.length(c.fields[0]["value"]))
    return got.select("paper", F.size("cards").cast("long").alias("n_cards"), chars.cast("long").alias("n_chars"), F.array_join(F.transform("cards", lambda c: c.label), ",").alias("roles"))


@query("""
WITH r AS (SELECT l_orderkey AS parent, l_linenumber AS slot, count(DISTINCT CAST(l_shipdate AS DATE)) FILTER (WHERE l_returnflag <> 'A') AS n, min(CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) FILTER (WHERE l_returnflag <> 'A') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS bad FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY 1, 2),
s AS (SELECT DISTINCT l_orderkey AS parent, l_linenumber AS slot FROM lineitem)
SELECT s.parent, s.slot, CASE WHEN coalesce(n, 0) = 1 THEN 'FILLED' WHEN n > 1 THEN 'AMBIGUOUS' WHEN bad > 0 THEN CASE WHEN s.slot = 1 THEN 'BLOCKED' ELSE 'SKIPPED' END ELSE 'OPEN' END AS state, CASE WHEN n = 1 THEN r END AS result FROM s LEFT JOIN r ON s.parent = r.parent AND s.slot = r.slot
""")
def slot_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("slot"), F.col("l_suppkey").alias("child"), F.when(F.col("l_returnflag") == "A", "FAILED").otherwise("DONE").alias("status"), F.col("l_shipdate").cast("date").cast("string").alias("result"))
    slots = rows.select("parent", "slot", (F.col("slot") == 1).alias("needed")).distinct()
    return control.slot_states(slots, rows.where("child % 4 != 0")).select("parent", "slot", "state", "result")


@query("""
SELECT o_orderkey AS member, [NULL, 'STARTED', 'WRITTEN', 'VERIFIED', 'COMMITTED', 'STARTED', NULL, NULL][1 + o_orderkey % 8] AS point, ['RUN', 'RUN', 'VERIFY', 'COMMIT', 'REUSE', 'RUN', 'RUN', 'RUN'][1 + o_orderkey % 8] AS action FROM orders
""")
def crash_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as members that stopped at each point, with a lost file, another content, or another configuration."""
    case = F.col("o_orderkey") % 8
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("member"), F.col("o_custkey").cast("string").alias("content"), case.alias("k"), F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256).alias("sha256"))
    points = F.slice(F.array(*map(F.lit, control.POINTS)), F.lit(1), F.when(F.col("k") > 4, 4).otherwise(F.col("k")).cast("int"))
    journal = rows.where("k > 0").select("member", F.explode(points).alias("point"), F.when(F.col("k") == 6, "old").otherwise(F.col("content")).alias("content"), F.when(F.col("k") == 7, "v0").otherwise("v1").alias("config"), "sha256")
    files = rows.where("k >= 2 AND k != 5").select("member", "sha256")
    return control.after_crash(rows.select("member", "content"), journal, files, "v1").select("member", "point", "action")


@query("""
WITH l AS (SELECT l_suppkey AS document, l_linenumber AS page, l_orderkey * 10 + l_linenumber AS block, round(l_quantity * 7, 3) AS x0, round(l_discount * 3000, 3) AS y0, l_returnflag, l_linestatus, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber, l_partkey, l_extendedprice) AS n FROM lineitem),
r AS (SELECT document, page, x0, y0 FROM l WHERE n % 40 = 1),
f AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.document = l.document AND r.page = l.page AND l.x0 >= r.x0 - 2 AND l.y0 >= r.y0 - 2 AND l.x0 + 6 <= r.x0 + 92 AND l.y0 + 4 <= r.y0 + 62)),
s AS (SELECT *, last_value(CASE WHEN l_returnflag = 'R' THEN true WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN false END IGNORE NULLS) OVER (PARTITION BY document ORDER BY n ROWS UNBOUNDED PRECEDING) AS o FROM f)
SELECT document, block, n FROM s WHERE o OR l_returnflag = 'A'
""")
def reading_scope_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as small boxes on a supplier's pages; every fortieth is also the corner of a table."""
    from pyspark.sql import Window

    from assaylake.operators import facts

    block = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_suppkey").orderBy(block, "l_partkey", "l_extendedprice")))
    x, y = F.round(F.col("l_quantity") * 7, 3), F.round(F.col("l_discount") * 3000, 3)
    blocks = rows.select(F.col("l_suppkey").alias("document"), F.col("l_linenumber").alias("page"), block.alias("block"), x.alias("x0"), y.alias("y0"), (x + 6).alias("x1"), (y + 4).alias("y1"), "l_returnflag", "l_linestatus", "n")
    regions = blocks.where("n % 40 = 1").select("document", "page", "x0", "y0", (F.col("x0") + 90).alias("x1"), (F.col("y0") + 60).alias("y1"))
    flag = F.col("l_returnflag")
    return facts.reading_scope(blocks, regions, ["n"], flag == "R", (flag == "N") & (F.col("l_linestatus") == "O"), flag == "A").select("document", "block", "n")


@query("""
WITH p AS (SELECT p_partkey AS k, p_size AS s, round(100 - p_size - CASE WHEN p_partkey % 7 = 0 THEN 3 ELSE 0 END, 0)::INT AS rest, p_partkey % 3 AS shape FROM part),
r AS (
  SELECT k, 'aggregate' AS shape, unnest([{'role': 'material', 'snippet': 'FA-' || k, 'w0': 0, 'w1': 0}, {'role': 'crystalline', 'snippet': s || '.0', 'w0': 2, 'w1': 2}, {'role': 'amorphous', 'snippet': rest || '.0', 'w0': 6, 'w1': 6}]) AS c, CAST(s + rest AS DOUBLE) AS total, CASE WHEN s + rest = 100 THEN 'CANDIDATE' ELSE 'INCONSISTENT' END AS status FROM p WHERE shape = 0
  UNION ALL SELECT k, 'direct', unnest([{'role': 'material', 'snippet': 'Slag S' || k, 'w0': 0, 'w1': 1}, {'role': 'value1', 'snippet': s || '.5', 'w0': 3, 'w1': 3}, {'role': 'phase1', 'snippet': 'quartz', 'w0': 5, 'w1': 5}, {'role': 'value2', 'snippet': '7', 'w0': 7, 'w1': 7}, {'role': 'phase2', 'snippet': 'mullite', 'w0': 9, 'w1': 9}]), NULL, 'CANDIDATE' FROM p WHERE shape = 1
  UNION ALL SELECT k, 'single_amorphous', unnest([{'role': 'material', 'snippet': 'GBS' || k, 'w0': 3, 'w1': 3}, {'role': 'qualifier', 'snippet': 'about', 'w0': 5, 'w1': 5}, {'role': 'value', 'snippet': CAST(s AS VARCHAR), 'w0': 6, 'w1': 6}]), NULL, 'CANDIDATE' FROM p WHERE shape = 2
)
SELECT k AS document, 1 AS page, shape, 1 AS fact, c.role AS role, c.snippet AS snippet, 20.0 * (c.w0 + 1) AS x0, 10.0 AS y0, 20.0 * (c.w1 + 1) + 15 AS x1, 18.0 AS y1, total, status FROM r
""")
def phase_fact_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each part: a word, a sentence about its phases in one of three shapes, and more words; a box for each word."""
    from assaylake.operators import facts

    k, s = F.col("p_partkey"), F.col("p_size")
    rest = F.lit(100) - s - F.when(k % 7 == 0, 3).otherwise(0)
    said = F.when(k % 3 == 0, F.concat(F.lit("FA-"), k, F.lit(" contained "), s, F.lit(".0 % crystalline and "), rest, F.lit(".0 wt.% amorphous phases.")))
    said = said.when(k % 3 == 1, F.concat(F.lit("Slag S"), k, F.lit(" contained "), s, F.lit(".5 wt.% quartz and 7 % mullite in all"))).otherwise(F.concat(F.lit("Amorphous content of GBS"), k, F.lit(" was about "), s, F.lit("% there")))
    words = table(spark, sf_dir, "part").select(k.alias("document"), F.lit(1).alias("page"), F.posexplode(F.split(F.concat(F.lit("then "), said, F.lit(" as 12 % of them said")), " ")).alias("place", "text"))
    x = 20.0 * F.col("place")
    found = facts.phase_facts(words.withColumns({"x0": x, "y0": F.lit(10.0), "x1": x + 15, "y1": F.lit(18.0)}))
    return found.select("document", "page", "shape", "fact", "role", "snippet", "x0", "y0", "x1", "y1", "total", "status")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem),
a AS (SELECT l_orderkey AS k, 'list' AS kind, CAST(r AS VARCHAR) AS n, 'cells' AS tier, 't' || l_orderkey || ':' || r || ':1' AS block, 't' || l_orderkey || ':' || r || ':1|t' || l_orderkey || ':' || r || ':2' AS blocks FROM l WHERE l_returnflag <> 'A'),
b AS (SELECT l_orderkey, 'one', CAST(r AS VARCHAR), 'cell', 't' || l_orderkey || ':' || r || ':0', 't' || l_orderkey || ':' || r || ':0' FROM l WHERE l_returnflag = 'A'),
c AS (SELECT l_orderkey, 'lost', '0', 'label', 't' || l_orderkey || ':' || max(r) || ':3', 't' || l_orderkey || ':' || max(r) || ':3|t' || l_orderkey || ':' || max(r) || ':4' FROM l GROUP BY l_orderkey),
d AS (SELECT o_orderkey, 'none', '0', NULL, NULL, NULL FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM l))
SELECT CAST(k AS VARCHAR) AS document, kind || n AS ref, tier, block, blocks FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM d)
""")
def evidence_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables with a row a line: tokens printed over two cells, cited cells, cells that are lost but named by their label, and labels that nothing says."""
    from pyspark.sql import Window

    from assaylake.plans.storage import written

    key, r = F.col("l_orderkey"), F.col("r")
    numbered = table(spark, sf_dir, "lineitem").withColumn("r", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")))
    rows = written(numbered.select("l_orderkey", "r", "l_partkey", "l_suppkey", "l_returnflag"))
    text = F.array(F.col("l_returnflag"), F.concat(F.col("l_partkey"), F.lit(",")), F.col("l_suppkey").cast("string"), F.lit("Ship mode"), F.lit("by rail"))
    name = lambda c: F.concat(F.lit("t"), key, F.lit(":"), r, F.lit(":"), c)
    grid = rows.select(key, r, F.posexplode(text).alias("c", "text"))
    cells = grid.select(key.alias("document"), F.concat(F.lit("t"), key).alias("table_id"), r.alias("row"), F.col("c").alias("column"), name(F.col("c")).alias("cell"), F.lit(1).alias("page"), *[F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1")], "text")
    none = F.lit(None).cast("string")
    ref = lambda kind, n, cited, quote, token: (key.alias("document"), F.concat(F.lit(kind), n).alias("ref"), cited.alias("cited"), quote.alias("quote"), token.alias("token"))
    listed = rows.where("l_returnflag != 'A'").select(*ref("list", r, name(F.lit(1)), none, F.concat(F.col("l_partkey"), F.lit(", "), F.col("l_suppkey"))))
    one = rows.where("l_returnflag = 'A'").select(*ref("one", r, name(F.lit(0)), none, none))
    orders = rows.where("r = 1").select(key)
    away = lambda c: F.concat(F.lit("t"), key, F.lit(f":99:{c}"))
    lost = orders.select(*ref("lost", F.lit("0"), away(3), F.lit("ship  MODE by rail"), none))
    nothing = orders.select(*ref("none", F.lit("0"), away(0), F.lit("by sea"), none))
    blocks = orders.select(key.alias("document"), F.lit("b").alias("block"), F.lit(1).alias("page"), *[F.lit(None).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], F.lit("no such words").alias("text"))
    found = evidence.locate(listed.unionByName(one).unionByName(lost).unionByName(nothing), blocks, cells)
    return found.select("document", "ref", "tier", "block", F.array_join("blocks", "|").alias("blocks"))
