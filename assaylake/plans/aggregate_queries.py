"""Merges, compositions, metrics, verdicts and control state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import json_paths, text, urls
from assaylake.operators import claims, composition, control, merging, scoring
from assaylake.plans.registry import query, table

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100.0 / t, 6) AS percent, round(t, 2) AS total, abs(t * (l_extendedprice * 100.0 / t) / 100.0 - l_extendedprice) <= 1e-6 AS reverse_ok FROM s
""")
def composition_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = composition.shares(table(spark, sf_dir, "lineitem").select(*LINE, "l_extendedprice"), "l_orderkey", "l_extendedprice")
    back = F.abs(F.col("total") * F.col("percent") / 100.0 - F.col("l_extendedprice")) <= 1e-6
    return rows.select(*LINE, F.round("percent", 6).alias("percent"), F.round("total", 2).alias("total"), back.alias("reverse_ok"))


@query("""
WITH b AS (SELECT *, greatest(l_quantity - 0.5, 0) AS lo, l_quantity + 0.5 AS hi FROM lineitem),
s AS (SELECT *, sum(lo) OVER w AS slo, sum(hi) OVER w AS shi, sum(l_quantity) OVER w AS t FROM b WINDOW w AS (PARTITION BY l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(100 * l_quantity / t, 6) AS percent, round(100 * lo / (lo + shi - hi), 6) AS lower, round(100 * hi / (hi + slo - lo), 6) AS upper FROM s
""")
def composition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = composition.bounds(table(spark, sf_dir, "lineitem").select(*LINE, "l_quantity"), "l_orderkey", "l_quantity", F.lit(0.5))
    return rows.select(*LINE, *[F.round(c, 6).alias(c) for c in ("percent", "lower", "upper")])


@query("SELECT l_orderkey, sum(l_quantity) AS total, CASE WHEN sum(l_quantity) > 150 THEN 'DEFECT' ELSE 'PASS' END AS verdict FROM lineitem GROUP BY l_orderkey")
def total_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composition.total_gate(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", 150.0)


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, round(sum(l_quantity) OVER (PARTITION BY l_orderkey), 8) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, t AS original_total, CASE WHEN t > 100.000001 THEN round(l_quantity / t * 100, 6) END AS normalised FROM t
""")
def total_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = composition.normalisation(table(spark, sf_dir, "lineitem").select(*LINE, "l_quantity"), "l_orderkey", "l_quantity")
    return rows.select(*LINE, "original_total", F.round("normalised", 6).alias("normalised"))


KEY = "trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
SELECT title_key, arg_min(lang, doc_id) AS lang, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, bool_or(n_chars > 2000) AS has_raw_points, count(*) AS n_merged
FROM (SELECT *, {KEY} AS title_key FROM documents) WHERE title_key <> '' GROUP BY title_key
""")
def candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.array("source").alias("sources"), (F.col("n_chars") > 2000).alias("has_raw_points"), text.title_key(F.col("text")).alias("title_key"))
    got = merging.merge_candidates(rows, "title_key", "doc_id", ["lang"], ["sources"], ["has_raw_points"])
    return got.withColumn("sources", F.array_join("sources", ","))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS canonical_id, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY text) THEN 'CANONICAL' ELSE 'DUPLICATE_ALIAS' END AS status FROM documents")
def duplicate_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content"))
    return merging.content_aliases(rows, "content", "doc_id").select("doc_id", "canonical_id", "status")


@query("""
WITH RECURSIVE h AS (SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z]+://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '') AS host, nullif(regexp_extract(lower(url), '^[a-z]+://[^/?#]+/([^?#]+)', 1), '') AS path FROM pages),
e AS (SELECT a.page_id AS x, b.page_id AS y FROM h a JOIN h b ON a.host = b.host UNION SELECT a.page_id, b.page_id FROM h a JOIN h b ON a.path = b.path),
r AS (SELECT page_id AS x, page_id AS y FROM h UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS page_id, min(y) AS root FROM r GROUP BY x
""")
def alias_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.lower("url")
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(url).alias("host"), F.nullif(F.regexp_extract(url, "^[a-z]+://[^/?#]+/([^?#]+)", 1), F.lit("")).alias("path"))
    return merging.alias_components(rows, "page_id", ["host", "path"])


@query()
def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.lower("url")
    path = F.nullif(F.regexp_extract(url, "^[a-z]+://[^/?#]+/([^?#]+)", 1), F.lit(""))
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(url).alias("host"), path.alias("path"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("10.1234/"), F.col("page_id") % 7)).alias("doi"))
    return merging.resolve_entities(rows, "page_id", ["host", "path"], "doi")


@query("""
SELECT CASE WHEN value < 5 THEN 'TRANSPORT_ERROR' WHEN CAST(json_extract_string(props, '$.k') AS INT) % 10 = 4 THEN 'NOT_FOUND' WHEN CAST(json_extract_string(props, '$.k') AS INT) % 10 = 3 THEN 'DENIED' WHEN CAST(json_extract_string(props, '$.k') AS INT) % 10 = 9 THEN 'RATE_LIMITED' ELSE 'HTTP_STATUS_200' END AS outcome, count(*) AS n
FROM events GROUP BY 1
""")
def link_class_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = json_paths.read(F.col("props"), "/k", "int") % 10
    status = F.when(k == 4, 404).when(k == 3, 403).when(k == 9, 429).otherwise(200)
    rows = table(spark, sf_dir, "events").select(urls.outcome(status, F.when(F.col("value") < 5, "timeout")).alias("outcome"))
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH a AS (SELECT 'A' AS arm, s_acctbal AS score, s_nationkey AS host FROM supplier UNION ALL SELECT 'B', c_acctbal, c_nationkey FROM customer),
m AS (SELECT arm, count(*) AS n, avg(score) AS mean_score, count(DISTINCT host) AS n_hosts, count(*) FILTER (WHERE score > 0) AS n_good FROM a GROUP BY arm),
v AS (SELECT max(CASE WHEN arm = 'A' THEN n_good * 1.0 / n END) AS share_a, max(CASE WHEN arm = 'B' THEN n_good * 1.0 / n END) AS share_b, max(CASE WHEN arm = 'A' THEN mean_score END) - max(CASE WHEN arm = 'B' THEN mean_score END) AS mean_drop FROM m)
SELECT round(share_a, 6) AS share_a, round(share_b, 6) AS share_b, round(mean_drop, 2) AS mean_drop, CASE WHEN mean_drop > 500 THEN 'INVALID' WHEN share_b >= 0.8 AND share_b - share_a >= 0.2 THEN 'PASS' WHEN share_b >= 0.8 OR share_b - share_a >= 0.2 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict FROM v
""")
def arm_metrics_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.lit("A").alias("arm"), F.col("s_acctbal").alias("score"), F.col("s_nationkey").alias("host"))
    b = table(spark, sf_dir, "customer").select(F.lit("B").alias("arm"), F.col("c_acctbal").alias("score"), F.col("c_nationkey").alias("host"))
    got = scoring.two_arm_verdict(scoring.arm_metrics(a.unionByName(b), "arm", "score", "host", F.col("score") > 0), "arm", "A", "B", 500.0, 0.8, 0.2)
    return got.select(F.round("share_a", 6).alias("share_a"), F.round("share_b", 6).alias("share_b"), F.round("mean_drop", 2).alias("mean_drop"), "verdict")


@query("""
WITH g AS (SELECT p.*, w.weight, p_retailprice / 100 + w.weight * CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS s FROM part p, (SELECT unnest([0, 2, 4, 6, 8, 10, 12]) AS weight) w),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY weight ORDER BY s DESC, p_partkey) AS r FROM g) WHERE r <= 20),
m AS (SELECT weight, CAST(sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS BIGINT) AS n_good, avg(p_retailprice) AS mean_score, count(DISTINCT p_brand) AS n_hosts FROM b GROUP BY weight)
SELECT weight, n_good, round(mean_score, 4) AS mean_score, viable, viable AND row_number() OVER (ORDER BY viable DESC, n_good DESC, mean_score DESC, weight) = 1 AS chosen FROM (SELECT *, max(CASE WHEN weight = 0 THEN mean_score END) OVER () - mean_score <= 30 AND n_hosts >= 3 AS viable FROM m)
""")
def weight_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 100).alias("score"), (F.col("p_size") > 25).cast("int").alias("good"), "p_brand")
    got = scoring.weight_grid(part, list(range(0, 13, 2)), 20, "score", "good", "good", "p_partkey", "p_brand", 3, 0.3)
    return got.select("weight", "n_good", F.round(F.col("mean_score") * 100, 4).alias("mean_score"), "viable", "chosen")


@query("""
WITH e AS (SELECT event_type AS task, CASE WHEN user_id % 2 = 0 THEN 'reader' ELSE 'writer' END AS role, CAST(floor(value) AS BIGINT) AS r, CAST(floor(value / 3) AS BIGINT) AS c, user_id AS m FROM events)
SELECT task, role, count(*) AS events, CAST(sum(r) AS BIGINT) AS raw_input, CAST(sum(m) AS BIGINT) AS output, CAST(sum(r) - sum(c) AS BIGINT) AS uncached, CAST(sum(r) - sum(c) + sum(m) AS BIGINT) AS proxy, round(sum(c) * 1.0 / sum(r), 6) AS cache_hit
FROM e GROUP BY GROUPING SETS ((task, role), ())
""")
def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("user_id") % 2 == 0, "reader").otherwise("writer").alias("role"), F.floor("value").cast("long").alias("r"), F.floor(F.col("value") / 3).cast("long").alias("c"), F.col("user_id").alias("m")
    )
    return scoring.usage_rollup(rows, "event_type", "role", "r", "c", "m")


@query("""
WITH e AS (SELECT event_type AS role, count(*) AS events, CAST(sum(floor(value)) AS BIGINT) AS proxy FROM events GROUP BY 1)
SELECT role, events, proxy, concat_ws(',', CASE WHEN role NOT IN ('click', 'view', 'purchase') THEN 'ROLE_NOT_ALLOWED' END, CASE WHEN events > 2000 THEN 'TOO_MANY_EVENTS' END, CASE WHEN proxy >= 100000 THEN 'BUDGET_EXCEEDED' END) AS reasons,
  CASE WHEN role IN ('click', 'view', 'purchase') AND events <= 2000 AND proxy < 100000 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM e
""")
def budget_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("role")).agg(F.count(F.lit(1)).alias("events"), F.sum(F.floor("value")).cast("long").alias("proxy"))
    return scoring.budget_reasons(usage, ["click", "view", "purchase"], 2000, 100000).withColumn("reasons", F.array_join("reasons", ","))


@query("""
WITH p AS (SELECT o_orderpriority, o_orderkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1) // 4096 AS run, o_orderdate FROM orders),
h AS (SELECT o_orderpriority, run, sha256(string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderdate, o_orderkey)) AS h, count(*) AS n FROM p GROUP BY 1, 2)
SELECT o_orderpriority, CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, chr(10) ORDER BY run)) END AS order_sha256, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1
""")
def order_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.struct("o_orderdate", "o_orderkey").alias("place"), "o_orderkey")
    return scoring.order_hash(rows, ["o_orderpriority"], "place", "o_orderkey")


@query("SELECT o_orderpriority AS grp, count(*) AS planned, count(*) FILTER (WHERE o_orderstatus <> 'P') AS captured, count(*) FILTER (WHERE o_orderstatus = 'P') AS missing, round(count(*) FILTER (WHERE o_orderstatus <> 'P') * 1.0 / count(*), 6) AS coverage, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') = 0 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS verdict FROM orders GROUP BY 1")
def status_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    plan = orders.select("o_orderkey", F.col("o_orderpriority").alias("grp"))
    return claims.completeness(plan, orders.where("o_orderstatus != 'P'"), "o_orderkey", "grp").withColumn("coverage", F.round("coverage", 6))


@query("""
WITH g AS (SELECT user_id, event_type, count(DISTINCT CAST(floor(value) AS BIGINT)) AS n, min(CAST(floor(value) AS BIGINT)) AS v, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS rk FROM events GROUP BY 1, 2),
h AS (SELECT user_id, rk, sum(n) AS n0 FROM g GROUP BY 1, 2),
f AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS rk, count(DISTINCT CAST(floor(value) AS BIGINT)) AS n, min(CAST(floor(value) AS BIGINT)) AS v, min(event_type) AS s FROM events GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rk) AS r, sum(n) OVER (PARTITION BY user_id) AS n_values FROM f)
SELECT user_id, CASE WHEN n = 1 THEN v END AS v, s AS event_type, CAST(n_values AS BIGINT) AS n_values, n > 1 AS conflict FROM b WHERE r = 1
""")
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.floor("value").cast("long").alias("v"))
    return merging.by_precedence(rows, ["user_id"], "event_type", "v", ["purchase", "click", "view"])


@query("SELECT p_brand, p_partkey, p_type, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_type LIKE 'STANDARD%' THEN 0 ELSE 1 END, p_size DESC, p_partkey) AS r FROM part) WHERE r = 1")
def best_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("p_type").startswith("STANDARD"), 0).otherwise(1)
    return merging.keep_best(table(spark, sf_dir, "part"), "p_brand", rank, F.desc("p_size"), "p_partkey").select("p_brand", "p_partkey", "p_type", "p_size")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, n_chars > 15000 AS c, bool_or(n_chars > 15000) OVER (PARTITION BY source) AS a FROM documents) WHERE c OR NOT a")
def prefer_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.prefer_complete(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "source", F.col("n_chars") > 15000).select("doc_id", "source")


@query("""
WITH h AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u, length(html) AS n FROM pages)
SELECT u AS url, page_id FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY n DESC, page_id) AS r FROM h) WHERE r = 1
""")
def keep_best_per_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"), F.length("html").alias("n"))
    return merging.keep_best(rows, "url", F.desc("n"), "page_id").select("url", "page_id")


@query("""
SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n_events, arg_max(ev, (ts, event_id)) AS last_event, arg_max(note, (ts, event_id)) FILTER (WHERE note IS NOT NULL) AS last_note, arg_max(ev, (ts, event_id)) NOT IN ('VERIFIED', 'EXERCISED') AS unresolved
FROM (SELECT *, CASE CAST(json_extract_string(props, '$.k') AS INT) % 4 WHEN 0 THEN 'OBSERVED' WHEN 1 THEN 'RESOLVED' WHEN 2 THEN 'VERIFIED' ELSE 'REOPENED' END AS ev, CASE WHEN value > 50 THEN event_type END AS note FROM events) GROUP BY user_id
""")
def fault_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = json_paths.read(F.col("props"), "/k", "int") % 4
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.when(k == 0, "OBSERVED").when(k == 1, "RESOLVED").when(k == 2, "VERIFIED").otherwise("REOPENED").alias("ev"), F.when(F.col("value") > 50, F.col("event_type")).alias("note"))
    return control.fault_families(rows, "user_id", "ev", "ts", "event_id", "note")


@query("""
WITH e AS (SELECT user_id, event_id, ts, CASE CAST(json_extract_string(props, '$.k') AS INT) % 4 WHEN 0 THEN 'OBSERVED' WHEN 1 THEN 'RESOLVED' WHEN 2 THEN 'VERIFIED' ELSE 'REOPENED' END AS ev FROM events),
l AS (SELECT *, lag(ev) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM e)
SELECT event_id, CASE WHEN before IS NULL AND ev NOT IN ('OBSERVED', 'EXERCISED') THEN 'FIRST_EVENT' WHEN ev = 'VERIFIED' AND before <> 'RESOLVED' THEN 'VERIFIED_WITHOUT_RESOLVED' WHEN ev = 'RESOLVED' AND before IN ('RESOLVED', 'VERIFIED') THEN 'NOT_OPEN' WHEN ev = 'REOPENED' AND before NOT IN ('RESOLVED', 'VERIFIED') THEN 'NOT_CLOSED' END AS error FROM l
""")
def fault_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = json_paths.read(F.col("props"), "/k", "int") % 4
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.when(k == 0, "OBSERVED").when(k == 1, "RESOLVED").when(k == 2, "VERIFIED").otherwise("REOPENED").alias("ev"))
    return control.fault_transitions(rows, "user_id", "ev", ["ts", "event_id"]).select("event_id", "error")


@query("""
WITH RECURSIVE e AS (SELECT user_id, ['LEASE', 'COMPLETE', 'FAIL', 'LOST'][1 + CASE WHEN event_id % 11 = 0 THEN 3 ELSE CAST(json_extract_string(props, '$.k') AS INT) % 3 END] AS ev, floor(epoch(CAST(ts AS TIMESTAMP))) AS t0, event_type AS o, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(CAST(ts AS TIMESTAMP))), event_id) AS n FROM events),
r AS (
  SELECT user_id, CAST(0 AS BIGINT) AS n, 'queued' AS status, CAST(NULL AS VARCHAR) AS owner, CAST(0 AS DOUBLE) AS expires, CAST(0 AS BIGINT) AS attempts, CAST(0 AS BIGINT) AS refused, CAST(0 AS BIGINT) AS hits, false AS stale FROM e WHERE n = 1
  UNION ALL
  SELECT user_id, n,
    CASE WHEN ev = 'LOST' AND status = 'succeeded' THEN 'retryable' WHEN ev = 'LEASE' AND ended THEN 'dead_letter' WHEN ev = 'LEASE' AND may THEN 'leased' WHEN mine AND ev = 'COMPLETE' THEN 'succeeded' WHEN mine AND ev = 'FAIL' THEN CASE WHEN attempts >= 3 THEN 'dead_letter' ELSE 'retryable' END ELSE status END,
    CASE WHEN (ev = 'LOST' AND status = 'succeeded') OR (ev = 'LEASE' AND ended) OR (mine AND ev IN ('COMPLETE', 'FAIL')) THEN NULL WHEN ev = 'LEASE' AND may THEN o ELSE owner END,
    CASE WHEN ev = 'LEASE' AND may THEN t0 + 86400 ELSE expires END, attempts + CASE WHEN ev = 'LEASE' AND may THEN 1 ELSE 0 END,
    refused + CASE WHEN (ev = 'LEASE' AND turned_away) OR (ev IN ('COMPLETE', 'FAIL') AND NOT mine) THEN 1 ELSE 0 END, hits + CASE WHEN ev = 'LEASE' AND status = 'succeeded' THEN 1 ELSE 0 END,
    CASE WHEN ev = 'LOST' AND status = 'succeeded' THEN true WHEN ev = 'LEASE' AND may THEN false ELSE stale END
  FROM (SELECT *, status <> 'succeeded' AND NOT turned_away AND attempts >= 3 AND NOT stale AS ended, status <> 'succeeded' AND NOT turned_away AND (attempts < 3 OR stale) AS may
    FROM (SELECT e.user_id, e.n, e.ev, e.t0, e.o, r.status, r.owner, r.expires, r.attempts, r.refused, r.hits, r.stale, r.status = 'leased' AND e.t0 < r.expires AND coalesce(r.owner = e.o, false) AS mine, r.status = 'dead_letter' OR (r.status = 'leased' AND e.t0 < r.expires AND r.owner <> e.o) AS turned_away FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1))
)
SELECT user_id, status, owner, attempts, refused, hits FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS z FROM r) WHERE z = 1
""")
def lease_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = json_paths.read(F.col("props"), "/k", "int") % 3
    event = F.when(F.col("event_id") % 11 == 0, "LOST").when(k == 0, "LEASE").when(k == 1, "COMPLETE").otherwise("FAIL")
    rows = table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("at"), "user_id", event.alias("event"), F.col("event_type").alias("owner"))
    return control.lease_states(rows, "user_id", "event", "at", "owner", "event_id", lease=86400.0)


@query("SELECT 'customer' AS collection, CAST(c_custkey AS VARCHAR) AS record_key, '/' || name AS field_path, value, 'reported' AS value_status FROM (UNPIVOT (SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer) ON c_name, c_nationkey, c_mktsegment INTO NAME name VALUE value)")
def claims_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.flatten(table(spark, sf_dir, "customer"), "c_custkey", "customer", ["c_name", "c_nationkey", "c_mktsegment"]).drop("value_type")


@query("SELECT CAST(c_custkey AS VARCHAR) AS record_key, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def claims_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "c_custkey"}
    return claims.assemble(claims.flatten(rows, "c_custkey", "customer"), fields)


@query("""
WITH e AS (SELECT CAST(event_id AS VARCHAR) AS record_key, json_extract_string(props, '$.k') AS k, event_type, event_id % 3 AS n FROM events)
SELECT record_key, '/a/0/b/c/d/e' AS field_path, k AS value FROM e UNION ALL SELECT record_key, '/a/1', event_type FROM e UNION ALL SELECT record_key, '/x~1y/z', '[]' FROM e WHERE n = 0
UNION ALL SELECT record_key, '/x~1y/z/' || i, CAST(i AS VARCHAR) FROM e, (SELECT unnest(range(2)) AS i) WHERE i < n
""")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested texts of up to six levels, with lists of zero to two items."""
    k = F.get_json_object("props", "$.k").cast("int")
    deep = F.struct(F.struct(F.struct(F.struct(k.alias("e")).alias("d")).alias("c")).alias("b"))
    text = F.concat(F.lit('{"a": ['), F.to_json(deep), F.lit(', "'), F.col("event_type"), F.lit('"], "x/y": {"z": ['), F.array_join(F.slice(F.array(F.lit("0"), F.lit("1")), F.lit(1), (F.col("event_id") % 3).cast("int")), ","), F.lit("]}}"))
    return claims.flatten_json(table(spark, sf_dir, "events").select("event_id", text.alias("text")), "event_id", "text")


@query("""
WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2),
d AS (SELECT x.vec_id, c.label, sum((v - m) * (v - m)) AS d FROM x JOIN c USING (i) GROUP BY 1, 2)
SELECT vec_id, arg_min(label, (round(d, 9), label)) AS nearest_label FROM d GROUP BY vec_id
""")
def nearest_palette(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    cells = rows.select("vec_id", "label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    means = cells.groupBy("label", "i").agg(F.avg("x").alias("m"))
    labels = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s.m).alias("mean"))
    if labels.count() > 4096:
        raise ValueError("a palette is a short list")
    palette = labels.agg(F.collect_list(F.struct("label", "mean")).alias("palette"))  # one row: a palette is a short list
    square = lambda p: F.aggregate(F.zip_with("embedding", p.mean, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda s, x: s + x)
    best = F.array_min(F.transform("palette", lambda p: F.struct(F.round(square(p), 9).alias("d"), p.label.alias("label"))))
    return rows.crossJoin(F.broadcast(palette)).select("vec_id", best["label"].alias("nearest_label"))


