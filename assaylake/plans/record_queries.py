"""Records, graphs, tasks and sources over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import display, json_paths, text, transforms
from assaylake.operators import cells, control, json_trees, merging, projection, relations, scoring, windows
from assaylake.plans.registry import query, table
from assaylake.plans.storage import dealt, written
from assaylake.sources import fetch, markers, pages


@query("""
WITH n AS (SELECT 'o' || o_orderkey AS node, 'order' AS t FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT 's' || s_suppkey, 'supplier' FROM supplier),
e AS (SELECT DISTINCT CASE WHEN l_suppkey % 13 = 0 THEN 'likes' ELSE 'supplied_by' END AS kind, 'o' || l_orderkey AS source, 's' || l_suppkey AS target, CAST(l_linenumber AS VARCHAR) AS scope FROM lineitem),
c AS (SELECT kind, source, scope, count(DISTINCT target) AS n FROM e GROUP BY 1, 2, 3)
SELECT e.kind, e.source, e.target, e.scope, CASE WHEN e.kind = 'likes' THEN 'UNKNOWN_KIND' WHEN a.node IS NULL OR b.node IS NULL THEN 'DANGLING_ENDPOINT' WHEN c.n > 1 THEN 'CONFLICTING_SCOPE' END AS defect
FROM e LEFT JOIN n a ON e.source = a.node LEFT JOIN n b ON e.target = b.node JOIN c ON e.kind = c.kind AND e.source = c.source AND e.scope = c.scope
""")
def graph_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 11 != 0").select(F.concat(F.lit("o"), "o_orderkey").alias("node"), F.lit("order").alias("node_type"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.lit("supplier").alias("node_type"))
    edges = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 13 == 0, "likes").otherwise("supplied_by").alias("kind"), F.concat(F.lit("o"), "l_orderkey").alias("source"), F.concat(F.lit("s"), "l_suppkey").alias("target"), F.col("l_linenumber").cast("string").alias("scope")
    ).distinct()
    rules = spark.createDataFrame([("supplied_by", "order", "supplier")], "kind string, source_type string, target_type string")
    return relations.graph_defects(edges, orders.unionByName(suppliers), rules)


@query("""
SELECT o_orderkey AS item, 'k' || (o_custkey % 50) AS owner_key, CASE WHEN o_orderkey % 3 = 0 THEN 'mortar' WHEN o_orderkey % 3 = 1 THEN 'paste' END AS specimen,
  CASE WHEN o_orderkey % 3 = 2 OR CASE WHEN o_custkey % 50 < 25 THEN 'mortar' ELSE 'paste' END = CASE WHEN o_orderkey % 3 = 0 THEN 'mortar' ELSE 'paste' END THEN 'k' || (o_custkey % 50) WHEN o_custkey % 25 <> 7 THEN 'k' || ((o_custkey + 25) % 50) END AS resolved_owner,
  CASE WHEN o_orderkey % 3 = 2 OR CASE WHEN o_custkey % 50 < 25 THEN 'mortar' ELSE 'paste' END = CASE WHEN o_orderkey % 3 = 0 THEN 'mortar' ELSE 'paste' END THEN 'KEPT' WHEN o_custkey % 25 <> 7 THEN 'MOVED' ELSE 'AMBIGUOUS' END AS status
FROM orders
""")
def owner_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.when(F.col("id") % 50 < 25, "mortar").otherwise("paste")
    owners = spark.range(50).select(F.concat(F.lit("k"), "id").alias("owner_key"), F.concat(F.lit("L"), F.col("id") % 25).alias("label"), kinds.alias("specimen"))
    owners = owners.unionByName(spark.sql("SELECT 'z1' AS owner_key, 'L7' AS label, 'mortar' AS specimen UNION ALL SELECT 'z2', 'L7', 'paste'"))
    items = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.concat(F.lit("k"), F.col("o_custkey") % 50).alias("owner_key"), F.when(F.col("o_orderkey") % 3 == 0, "mortar").when(F.col("o_orderkey") % 3 == 1, "paste").alias("specimen"))
    return relations.resolve_owners(items, owners, "item")


@query("""
WITH v AS (SELECT CAST(o_custkey AS VARCHAR) AS record, '/' || o_orderstatus || '/' || o_orderkey AS field_path, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS value,
  CASE WHEN o_orderkey % 3 = 0 THEN 'derived' WHEN o_orderkey % 3 = 1 THEN 'estimate' END AS method, CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS er, CAST(o_orderkey % 6 AS VARCHAR) AS source_id FROM orders)
SELECT c_custkey AS slot, field_path, value, CASE method WHEN 'derived' THEN 'derived' WHEN 'estimate' THEN 'estimate' ELSE 'direct' END AS directness
FROM customer JOIN v ON record = CAST(c_custkey AS VARCHAR) WHERE value IS NOT NULL AND er = record AND source_id IN ('1', '2', '3') AND field_path LIKE '/F/%'
""")
def reusable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    own = F.col("o_custkey").cast("string")
    values = o.select(
        own.alias("record"), F.concat(F.lit("/"), "o_orderstatus", F.lit("/"), "o_orderkey").alias("field_path"), F.when(F.col("o_orderkey") % 4 != 0, F.floor("o_totalprice").cast("long").cast("string")).alias("value"),
        F.when(F.col("o_orderkey") % 3 == 0, "derived").when(F.col("o_orderkey") % 3 == 1, "estimate").alias("method"), F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(own).alias("evidence_record"), (F.col("o_orderkey") % 6).cast("string").alias("source_id"),
    )
    slots = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slot"), F.col("c_custkey").cast("string").alias("record"), F.lit("/F").alias("path"), F.array(*map(F.lit, "123")).alias("source_ids"))
    sources = spark.range(4).select(F.col("id").cast("string").alias("source_id"))
    return relations.reusable_values(slots, values, sources)


@query("""
SELECT o_orderpriority AS paper, count(*) AS n, round(count(*) FILTER (WHERE o_orderstatus <> 'P') * 1.0 / count(*), 6) AS recall, round(count(*) FILTER (WHERE o_orderstatus = 'F') * 1.0 / count(*) FILTER (WHERE o_orderstatus <> 'P'), 6) AS correctness,
  CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') * 1.0 / count(*) >= 0.6 AND count(*) FILTER (WHERE o_orderstatus = 'F') * 1.0 / count(*) FILTER (WHERE o_orderstatus <> 'P') >= 0.5 THEN 'PASS' ELSE 'REJECT' END AS verdict
FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())
""")
def correctness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = relations.correctness_gate(table(spark, sf_dir, "orders"), "o_orderpriority", F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F", 0.6, 0.5)
    return got.select(F.col("o_orderpriority").alias("paper"), "n", F.round("recall", 6).alias("recall"), F.round("correctness", 6).alias("correctness"), "verdict")


@query("""
WITH m AS (SELECT doc_id, source, text, CASE WHEN doc_id % 7 = 0 THEN 'ISOLATED' ELSE 'ACCEPTED' END AS status, CASE WHEN doc_id % 14 <> 0 THEN CAST(doc_id // 2 AS VARCHAR) END AS record_key FROM documents)
SELECT count(*) AS n_members, count(DISTINCT text) FILTER (WHERE status = 'ACCEPTED') AS accepted_contents, count(*) FILTER (WHERE status = 'ACCEPTED') - count(DISTINCT text) FILTER (WHERE status = 'ACCEPTED') AS duplicate_work,
  count(*) FILTER (WHERE status = 'ISOLATED' AND record_key IS NOT NULL) AS isolated_with_records, (SELECT count(*) FROM (SELECT record_key FROM m WHERE status = 'ACCEPTED' GROUP BY record_key HAVING count(DISTINCT source) > 1)) AS keys_across_papers FROM m
""")
def batch_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("doc_id") % 7 == 0, "ISOLATED").otherwise("ACCEPTED")
    key = F.when(F.col("doc_id") % 14 != 0, F.floor(F.col("doc_id") / 2).cast("string"))
    return relations.batch_invariants(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("member"), F.col("source").alias("paper"), F.sha2(F.col("text").cast("binary"), 256).alias("content"), status.alias("status"), key.alias("record_key")))


@query("SELECT p_partkey, p_brand, CASE WHEN p_size BETWEEN 10 AND 30 AND p_size % 3 <> 0 THEN 'FORMAL' ELSE 'CANDIDATE' END AS status FROM part")
def promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("long").alias("digest"))
    accepted = spark.range(10, 31).select(F.col("id").alias("digest"), F.lit("ACCEPTED").alias("verdict"), F.when(F.col("id") % 3 == 0, F.array(F.lit("d"))).otherwise(F.array().cast("array<string>")).alias("defects"))
    return relations.promote(rows, accepted, ["digest"]).select("p_partkey", "p_brand", "status")


@query("SELECT doc_id AS member, CASE WHEN doc_id % 5 = 0 THEN 'RUN' WHEN doc_id % 5 = 1 THEN 'REDO' WHEN doc_id % 5 = 2 THEN 'REDO' ELSE 'REUSE' END AS action FROM documents")
def resume_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("member"), F.sha2(F.col("text").cast("binary"), 256).alias("content"))
    rest = F.col("member") % 5
    done = rows.select("member", F.when(rest == 1, "old").otherwise(F.col("content")).alias("content"), F.when(rest == 2, "v0").otherwise("v1").alias("config"), F.when(rest == 0, "FAILED").otherwise("DONE").alias("status"))
    return control.resume(rows, done, "v1").select("member", "action")


@query("""
WITH t AS (SELECT conv_id * 1000 + turn AS task, conv_id, turn, CASE WHEN role = 'system' OR turn = 0 THEN 'DONE' WHEN conv_id % 3 = 0 AND turn = 1 THEN 'FAILED' END AS s FROM conversations)
SELECT t.task, CASE WHEN t.s = 'DONE' THEN 'CACHED' WHEN p.s = 'FAILED' THEN 'BLOCKED' WHEN p.task IS NOT NULL AND p.s IS NULL THEN 'WAITING' ELSE 'READY' END AS state FROM t LEFT JOIN t p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
""")
def ready_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", (F.col("conv_id") * 1000 + F.col("turn")).alias("task"))
    tasks = rows.select("task", F.col("task").cast("string").alias("cache_key"))
    edges = rows.select((F.col("task") - 1).alias("parent"), F.col("task").alias("child"))
    status = F.when((F.col("role") == "system") | (F.col("turn") == 0), "DONE").when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 1), "FAILED")
    results = rows.select(F.col("task").cast("string").alias("cache_key"), status.alias("status")).where("status IS NOT NULL")
    return control.ready_tasks(tasks, edges, results).select("task", "state")


@query("SELECT conv_id, sha256(string_agg(sha256(text), '' ORDER BY turn)) AS seal, count(*) AS n FROM conversations GROUP BY conv_id")
def packet_seal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    return control.sealed(rows, "conv_id", "turn", "digest")


@query("""
SELECT sha256(CAST(page_id AS VARCHAR)) AS page_id_sha256, length(html) AS size FROM pages
""")
def body_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("size"))
    return pages.body_free(rows, ["page_id"], ["size"])


@query("SELECT page_id FROM pages WHERE regexp_matches(url, '(?i)https?://|\\b10\\.[0-9]{4,9}/')")
def leak_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.leaks(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id")


@query("""
SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'FETCH' WHEN user_id % 4 = 1 THEN 'REPLAYED_FAILURE' WHEN ts >= TIMESTAMP '2024-01-15 00:00:00' THEN 'CACHE' ELSE 'FETCH' END AS source FROM events
""")
def cached_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "props", F.col("event_id").cast("string").alias("url_sha256"), F.lit("v1").alias("contract"))
    sha = F.sha2(F.concat_ws("|", "url_sha256", "props").cast("binary"), 256)
    receipts = rows.where("user_id % 4 != 0").select("url_sha256", "contract", F.when(F.col("user_id") % 4 == 1, "TERMINAL_FAILURE").otherwise("OK").alias("status"), F.col("ts").alias("fetched_at"), sha.alias("payload_sha256"))
    payloads = rows.select(sha.alias("payload_sha256"), F.concat_ws("|", "url_sha256", "props").alias("payload"))
    got = pages.usable_pages(rows.select("url_sha256", "contract"), receipts, payloads, F.lit("2024-02-14 00:00:00").cast("timestamp"))
    return got.select(F.col("url_sha256").cast("long").alias("event_id"), "source")


@query("""
WITH e AS (SELECT user_id AS c, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS o, value AS y FROM events), n AS (SELECT c, CAST(o AS DOUBLE) AS x, y, lead(CAST(o AS DOUBLE)) OVER w AS x1, lead(y) OVER w AS y1 FROM e WINDOW w AS (PARTITION BY c ORDER BY o)),
t AS (SELECT c, x, y, x1, y1, y >= 90 AND 90 > y1 AS hc, y >= 83 AND 83 > y1 AS hl, y >= 97 AND 97 > y1 AS hh FROM n),
g AS (SELECT c, count(*) FILTER (WHERE hc) AS nc, count(*) FILTER (WHERE hl) AS nl, count(*) FILTER (WHERE hh) AS nh, max(CASE WHEN hc THEN x + (90 - y) / (y1 - y) * (x1 - x) END) AS x, min(CASE WHEN hc OR hl OR hh THEN x END) AS a, max(CASE WHEN hc OR hl OR hh THEN x1 END) AS b FROM t GROUP BY c),
r AS (SELECT *, CASE WHEN nc <> 1 THEN 'NON_UNIQUE_OR_MISSING_CROSSING' WHEN nl <> 1 OR nh <> 1 THEN 'UNCERTAINTY_CROSSING_NOT_BOUNDED' END AS reason FROM g)
SELECT c AS user_id, CASE WHEN reason IS NULL THEN round(x, 6) END AS x, CASE WHEN reason IS NULL THEN a - 2 END AS x_low, CASE WHEN reason IS NULL THEN b + 2 END AS x_high, CASE WHEN reason IS NULL THEN 'CANDIDATE' ELSE 'QUARANTINED' END AS status, reason FROM r
""")
def raster_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = table(spark, sf_dir, "events").select("user_id", order.alias("ordinal"), F.col("value").alias("y")).withColumn("x", F.col("ordinal").cast("double"))
    got = windows.raster_percentile(rows, "user_id", 90.0, 85.0, 95.0, 10.0, 2.0)
    return got.select("user_id", F.round("x", 6).alias("x"), "x_low", "x_high", "status", "reason")


@query("""
WITH s AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?]\\s+')) AS s, generate_subscripts(regexp_split_to_array(text, '[.!?]\\s+'), 1) AS place FROM documents WHERE text IS NOT NULL),
ends AS (SELECT doc_id, unnest(regexp_extract_all(text, '([.!?])\\s+', 1)) AS e, generate_subscripts(regexp_extract_all(text, '([.!?])\\s+', 1), 1) AS place FROM documents WHERE text IS NOT NULL),
w AS (SELECT s.doc_id, trim(s.s || coalesce(e.e, '')) AS s, s.place FROM s LEFT JOIN ends e ON s.doc_id = e.doc_id AND s.place = e.place),
d AS (SELECT doc_id, s, min(place) AS place FROM w WHERE s <> '' GROUP BY doc_id, s)
SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY place)) AS sentences_sha256 FROM d GROUP BY doc_id
""")
def method_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    return found.select("doc_id", F.size("s").cast("long").alias("n"), F.sha2(F.array_join("s", "\n").cast("binary"), 256).alias("sentences_sha256"))


@query("SELECT doc_id, substr(text, 1, 240) AS snippet, sha256(text) AS sha256 FROM documents")
def evidence_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncated_snippet(F.col("text")).alias("s")).select("doc_id", "s.snippet", "s.sha256")


@query("""
SELECT event_id, CASE WHEN user_id = 0 THEN '0.0 h' WHEN user_id % 2 = 0 THEN CAST(user_id // 2 AS VARCHAR) || ' h' WHEN user_id * 1800 >= 1000000 THEN CAST(CAST(round(user_id * 1800 / 1000.0) * 1000 AS BIGINT) AS VARCHAR) || ' s' ELSE CAST(user_id * 1800 AS VARCHAR) || ' s' END AS shown,
  CASE WHEN event_id % 3 = 0 THEN 'sealed, 20 °C, ' WHEN event_id % 3 = 1 THEN 'steam, ' ELSE '65.5 °C, 95 % RH, ' END || CAST(1 + user_id % 28 AS VARCHAR) || ' h' AS stage
FROM events
""".replace("round(user_id * 1800 / 1000.0) * 1000", "round(user_id * 1800 / pow(10, floor(log10(user_id * 1800)) - 5)) * pow(10, floor(log10(user_id * 1800)) - 5)"))
def curing_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("event_id") % 3
    method, warm, wet = F.when(third == 0, "sealed").when(third == 1, "steam"), F.when(third == 0, 20.0).when(third == 2, 65.5), F.when(third == 2, 95.0)
    stage = display.curing(method, warm, wet, ((1 + F.col("user_id") % 28) * 3600).cast("double"))
    return table(spark, sf_dir, "events").select("event_id", display.duration((F.col("user_id") * 1800).cast("double")).alias("shown"), stage.alias("stage"))


@query("SELECT o_orderkey, substr(sha256('{\"contract\":\"v1\",\"customer\":' || o_custkey || ',\"note\":null}'), 1, 24) AS job_id FROM orders")
def idempotency_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = json_paths.content_id(24, customer=F.col("o_custkey"), contract=F.lit("v1"), note=F.lit(None).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("job_id"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def new_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return control.new_jobs(queue, table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey")


@query("""
SELECT coalesce(a.k, b.k) AS k, CASE WHEN NOT (a.v IS NOT NULL AND b.v IS NOT NULL AND a.v <> b.v) THEN coalesce(a.v, b.v) END AS v, CASE WHEN a.v <> b.v THEN 'CONFLICT' WHEN a.v IS NULL AND b.v IS NOT NULL THEN 'FILLED' ELSE 'KEPT' END AS status
FROM (SELECT s_suppkey AS k, CASE WHEN s_nationkey % 3 <> 0 THEN s_nationkey END AS v FROM supplier) a FULL JOIN (SELECT c_custkey AS k, c_nationkey AS v FROM customer) b ON a.k = b.k
""")
def null_filling_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_nationkey") % 3 != 0, F.col("s_nationkey")).alias("v"))
    right = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"))
    return merging.fill_nulls(left, right, "k", "v")


@query("SELECT 'left' AS side, count(*) AS n FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 1 EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 2) UNION ALL SELECT 'right', count(*) FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 2 EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 1)")
def rebuild_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return merging.same_rows(*[rows.where(f"l_linenumber = {n}").select("l_partkey", "l_quantity") for n in (1, 2)])


@query("SELECT s_suppkey, kind, substr(sha256(s_suppkey || '|' || kind), 1, 24) AS variant_key FROM supplier, (VALUES ('paste'), ('mortar')) AS t(kind)")
def specimen_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixes = table(spark, sf_dir, "supplier").select("s_suppkey")
    declared = mixes.select("s_suppkey", F.explode(F.array(F.lit("paste"), F.lit("mortar"))).alias("kind"))
    return projection.specimen_variants(mixes, declared, "s_suppkey", "kind")


@query("""
WITH c AS (SELECT n_regionkey AS table_id, 0 AS col, n_name AS t, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS r FROM nation)
SELECT n_nationkey AS request, CAST(r AS INT) AS "row", 1 AS "column", 'v' || n_nationkey AS text, CAST(1 AS BIGINT) AS n_hits FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS r FROM nation)
""")
def property_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    nation = table(spark, sf_dir, "nation").withColumn("row", place)
    body = nation.select(F.col("n_regionkey").alias("table_id"), "row", F.explode(F.array(F.struct(F.lit(0).alias("column"), F.col("n_name").alias("text")), F.struct(F.lit(1).alias("column"), F.concat(F.lit("v"), "n_nationkey").alias("text")))).alias("c")).select("table_id", "row", "c.*")
    head = nation.select(F.col("n_regionkey").alias("table_id")).distinct().select("table_id", F.lit(0).alias("row"), F.lit(1).alias("column"), F.lit("strength").alias("text"))
    wanted = nation.select(F.col("n_nationkey").alias("request"), F.col("n_regionkey").alias("table_id"), F.col("n_name").alias("specimen"), F.lit("strength").alias("property"))
    return cells.property_cells(body.unionByName(head), wanted).select("request", "row", "column", "text", "n_hits")


@query("SELECT CAST(p_partkey AS VARCHAR) AS paper, 'mat-FA-' || p_partkey AS mat_key, 'fly ash' AS material_type, round(p_size * 100 * 0.1, 6) AS specific_surface_m2_kg FROM part")
def marker_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("TITLE|x\nMATERIAL|FA-"), "p_partkey", F.lit("|material_type=fly ash|specific_surface="), F.col("p_size") * 100, F.lit("|specific_surface_unit=cm2/g\nnoise"))
    papers = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("paper"), line.alias("text"))
    return markers.materials(markers.lines(papers)).select("paper", "mat_key", "material_type", F.round("specific_surface_m2_kg", 6).alias("specific_surface_m2_kg"))


@query("""
SELECT o_orderkey, [NULL, 'TOO_FEW_TICKS', 'DUPLICATE_PIXEL', 'NON_POSITIVE_LOG_TICK', 'NOT_MONOTONIC', 'RESIDUAL', NULL][1 + o_orderkey % 7] AS defect FROM orders
""")
def tick_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axes around the orders' keys: sound linear and logarithmic ones and one for each defect."""
    kind, k = (F.col("o_orderkey") % 7).cast("int"), (F.col("o_custkey") % 50).cast("double")
    tick = lambda px, value: F.struct((k + px).alias("px"), F.lit(float(value)).alias("value"))
    cases = ([(30, 30), (0, 0), (10, 10), (20, 20)], [(0, 0), (10, 10)], [(0, 0), (10, 10), (10, 15), (20, 20)], [(0, 0), (10, 1), (20, 10)], [(0, 0), (10, 10), (20, 5), (30, 30)], [(0, 0), (13, 10), (20, 20)], [(0, 1000), (10, 100), (20, 10), (30, 1)])
    ticks = F.array(*[F.array(*[tick(*t) for t in c]) for c in cases])[kind]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", ticks.alias("ticks"), kind.isin(3, 6).alias("log"))
    return rows.select("o_orderkey", transforms.tick_defect(F.col("ticks"), F.col("log"), F.lit(0.5)).alias("defect"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'INCOMPLETE' WHEN o_totalprice > 100000 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM orders")
def three_way_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", scoring.gate(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000).alias("outcome"))


@query("""
WITH e AS (SELECT event_id, user_id % 4 AS kind, ts >= TIMESTAMP '2024-01-15 00:00:00' AS fresh FROM events),
s AS (SELECT event_id, CASE WHEN kind = 0 AND fresh THEN 'CACHE' WHEN kind = 1 THEN 'REPLAYED_FAILURE' WHEN kind = 2 THEN 'SEED' ELSE 'NETWORK' END AS source FROM e)
SELECT event_id, CASE WHEN source = 'NETWORK' AND row_number() OVER (PARTITION BY source ORDER BY event_id) > 72 THEN 'OVER_BUDGET' ELSE source END AS source FROM s
""")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("place"), F.col("event_id").cast("string").alias("url_sha256"), F.lit("v1").alias("contract"), (F.col("user_id") % 4).alias("kind"), F.col("ts").cast("timestamp").alias("fetched_at"))
    receipts = rows.where("kind < 2").withColumn("status", F.when(F.col("kind") == 0, "OK").otherwise("TERMINAL_FAILURE"))
    got = fetch.request_plan(rows.select("place", "url_sha256", "contract"), receipts, rows.where("kind = 2"), F.lit("2024-02-14 00:00:00").cast("timestamp"), 72, 50 << 20, 1 << 10)
    return got.select(F.col("place").alias("event_id"), "source")


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested text for each order, its names in no order."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"), F.when(F.col("l_quantity") < 10, F.array(F.lit("small"))).otherwise(F.array()).alias("tags"))
    lines = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", line.alias("line")), "l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    head = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("cust"), F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("rank")).alias("key"))
    body = F.struct(head.alias("order"), F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)).alias("lines"))
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "lines", F.to_json(body, {"ignoreNullFields": "false", "pretty": "true"}).alias("text"))


ORDER_TEXTS = """
l AS (SELECT l_orderkey, string_agg('{"flag":"' || l_returnflag || '","n":' || l_linenumber || {NOTE} || ',"part":' || l_partkey || ',"tags":[' || CASE WHEN l_quantity < 10 THEN '"small"' ELSE '' END || ']}', ',' ORDER BY l_linenumber, l_partkey, l_returnflag, l_quantity < 10) AS lines FROM lineitem GROUP BY l_orderkey),
t AS (SELECT o_orderkey, o_custkey, o_orderstatus, '"lines":[' || coalesce(lines, '') || '],"order":{"key":{"cust":' || o_custkey || ',"rank":' || CASE WHEN o_orderstatus = 'P' THEN '"' || o_orderpriority || '"' ELSE 'null' END || '},"status":"' || o_orderstatus || '"}' AS body
  FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
"""


@query("WITH " + ORDER_TEXTS.replace("{NOTE}", "''") + "SELECT CAST(o_orderkey AS VARCHAR) AS record_key, '{' || body || '}' AS json FROM t")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_trees.rebuilt(json_trees.leaves(order_texts(spark, sf_dir), "o_orderkey", "text"))


NOTE = """CASE WHEN l_returnflag = 'R' THEN ',"note":{"late":true}' ELSE '' END"""


@query("WITH " + ORDER_TEXTS.replace("{NOTE}", NOTE) + """
SELECT CAST(o_orderkey AS VARCHAR) AS record_key, CASE WHEN o_custkey % 10 <> 0 THEN '{' || CASE WHEN o_orderstatus = 'P' THEN '"audit":{"by":[null,{"user":' || o_custkey || '}]},' ELSE '' END || body || '}' END AS json,
  CASE WHEN o_custkey % 10 = 0 THEN 'scalar_parent /order/status' ELSE '' END AS defects
FROM t
""")
def json_set_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late lines get a note, open orders a list that is not there yet; some orders are asked for what cannot be."""
    texts = written(order_texts(spark, sf_dir))
    edit = lambda pointer, value: (F.col("key").cast("string").alias("record_key"), pointer.alias("pointer"), value.alias("value"))
    keyed = texts.withColumn("key", F.col("o_orderkey"))
    late = keyed.select("key", F.posexplode("lines").alias("place", "line")).where("line.flag = 'R'").select(*edit(F.concat(F.lit("/lines/"), "place", F.lit("/note")), F.lit('{"late": true}')))
    opened = keyed.where("o_orderstatus = 'P'").select(*edit(F.lit("/audit/by/1/user"), F.col("o_custkey").cast("string")))
    wrong = keyed.where("o_custkey % 10 = 0").select(*edit(F.lit("/order/status/x"), F.lit("1")))
    found = json_trees.set_pointers(texts, "o_orderkey", "text", late.unionByName(opened).unionByName(wrong))
    return found.withColumn("defects", F.array_join("defects", ","))
