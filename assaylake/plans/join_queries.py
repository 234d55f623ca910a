"""Joins under contracts, pairings, localisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import urls
from assaylake.operators import claims, contracts, matching, projection
from assaylake.plans.registry import query, table


@query("""
SELECT c_custkey, CASE WHEN n = 1 THEN o_orderkey END AS o_orderkey, CASE WHEN n IS NULL THEN 'MISSING' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'EXTRACTED' END AS status
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000 GROUP BY o_custkey) ON c_custkey = o_custkey
""")
def exactly_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice > 200000").select("o_custkey", "o_orderkey")
    return contracts.exactly_one(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey", "o_custkey").select("c_custkey", "o_orderkey", "status")


@query("""
SELECT 'lineitem.orders' AS edge, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_orphans FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'lineitem.part', count(*), count(*) FILTER (WHERE p_partkey IS NULL) FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'lineitem.supplier', count(*), count(*) FILTER (WHERE s_suppkey IS NULL) FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
UNION ALL SELECT 'orders.customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def fk_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "customer")}
    edges = [("lineitem", "orders", "l_orderkey", "o_orderkey"), ("lineitem", "part", "l_partkey", "p_partkey"), ("lineitem", "supplier", "l_suppkey", "s_suppkey"), ("orders", "customer", "o_custkey", "c_custkey")]
    return contracts.union_all([contracts.foreign_key(t[c].select(ck), t[p], ck, pk, f"{c}.{p}") for c, p, ck, pk in edges])


@query("""
WITH e AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_key, CASE WHEN o_orderkey % 2 = 0 THEN '/o_totalprice' ELSE '/o_orderdate' END AS field_path, o_orderkey FROM orders),
p AS (SELECT o_orderkey AS k, min(l_partkey) AS ev FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 5 <> 0 GROUP BY o_orderkey)
SELECT e.record_key, e.field_path, CASE WHEN p.ev IS NULL THEN 'missing_provenance' WHEN p.ev % 7 = 0 THEN 'missing_evidence' WHEN p.ev % 11 = 0 THEN 'evidence_mismatch' WHEN p.ev % 13 = 0 THEN 'invalid_page' END AS reason
FROM e LEFT JOIN p ON e.o_orderkey = p.k
""")
def provenance_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    path = F.when(F.col("o_orderkey") % 2 == 0, "/o_totalprice").otherwise("/o_orderdate")
    expected = orders.select(F.col("o_orderkey").cast("string").alias("record_key"), path.alias("field_path"))
    first = table(spark, sf_dir, "lineitem").where("l_orderkey % 5 != 0").groupBy("l_orderkey").agg(F.min("l_partkey").alias("ev"))
    first = first.join(orders, first["l_orderkey"] == orders["o_orderkey"])
    key = F.concat_ws(":", "l_orderkey", "ev")
    provenance = first.select(F.col("l_orderkey").cast("string").alias("record_key"), path.alias("field_path"), key.alias("evidence_key"))
    record = F.when(F.col("ev") % 11 == 0, "another").otherwise(F.col("l_orderkey").cast("string"))
    evidence = first.where("ev % 7 != 0").select(key.alias("evidence_key"), record.alias("evidence_record"), F.when(F.col("ev") % 13 == 0, 0).otherwise(1).alias("page"))
    return claims.provenance_reason(expected, provenance, evidence, F.lit(10)).select("record_key", "field_path", "reason")


@query("""
SELECT count(*) FILTER (WHERE parts IS NULL) AS n_missing, count(*) FILTER (WHERE coalesce(parts, 0) > 1) AS n_overlapping, CAST(0 AS BIGINT) AS n_foreign, count(*) AS n_keys,
  CASE WHEN count(*) FILTER (WHERE parts IS NULL OR parts > 1) = 0 THEN 'PASS' ELSE 'REJECT' END AS verdict
FROM (SELECT n_nationkey FROM nation) LEFT JOIN (SELECT n_nationkey AS k, count(DISTINCT r_name) AS parts FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7 GROUP BY n_nationkey) ON n_nationkey = k
""")
def set_partition_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    parts = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).where("n_nationkey != 7")
    return contracts.partition_gate(nation, parts, "n_nationkey", "r_name")


@query("""
WITH p AS (SELECT p_partkey, 'low' AS pool FROM part WHERE p_size <= 20 UNION ALL SELECT p_partkey, 'mid' FROM part WHERE p_size BETWEEN 15 AND 35 UNION ALL SELECT p_partkey, 'high' FROM part WHERE p_size > 35)
SELECT a.pool AS pool_a, b.pool AS pool_b, count(*) AS n_shared FROM p a JOIN p b ON a.p_partkey = b.p_partkey AND a.pool < b.pool GROUP BY 1, 2
""")
def disjoint_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    cuts = {"low": F.col("p_size") <= 20, "mid": F.col("p_size").between(15, 35), "high": F.col("p_size") > 35}
    return contracts.disjoint_pools(contracts.union_all([part.where(c).select("p_partkey", F.lit(n).alias("pool")) for n, c in cuts.items()]), "pool", "p_partkey")


@query("""
WITH u AS (SELECT page_id, string_split(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^?#]*)', 1), '/+$', ''), '/') AS parts FROM pages),
paths AS (SELECT page_id, array_to_string(parts, '/') AS path, parts FROM u),
own AS (SELECT DISTINCT page_id, array_to_string(parts[1:n], '/') AS p FROM paths, unnest(range(1, len(parts) + 1)) AS t(n)),
held AS (SELECT path AS p, count(*) AS n FROM paths GROUP BY path UNION SELECT parts[1], 2 FROM paths GROUP BY 1),
held2 AS (SELECT DISTINCT p FROM held WHERE n >= 2)
SELECT page_id, path, (SELECT p FROM own JOIN held2 USING (p) WHERE own.page_id = paths.page_id ORDER BY length(p) DESC LIMIT 1) AS prefix FROM paths
""")
def longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_extract("url", "^[a-zA-Z]+://([^?#]*)", 1), "/+$", "")
    pages = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    common = pages.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("path")
    known = common.unionByName(pages.select(F.split("path", "/")[0].alias("path"))).distinct().withColumnRenamed("path", "known")
    return matching.longest_prefix(pages, known, "path", "known").select("page_id", "path", "prefix")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS day FROM events),
m AS (SELECT t.event_id, a.event_id AS anchor, CASE WHEN t.k = a.k THEN 1 WHEN t.day = a.day THEN 2 WHEN t.k // 10 = a.k // 10 THEN 3 END AS tier, abs(t.event_id - a.event_id) AS distance FROM e t JOIN e a ON t.user_id = a.user_id AND t.event_type <> 'purchase' AND a.event_type = 'purchase')
SELECT event_id, anchor, tier, distance FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY tier, distance, anchor) AS r FROM m WHERE tier IS NOT NULL) WHERE r = 1
""")
def nearest_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event that is no purchase with the user's purchase that anchors it: the same key, else the same day, else the same tens of the key."""
    k = F.get_json_object("props", "$.k").cast("long")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", k.alias("k"), F.col("ts").cast("timestamp").cast("date").alias("day"), F.floor(k / 10).alias("tens"), F.col("event_id").alias("place"))
    got = matching.nearest_anchor(rows.where("event_type != 'purchase'"), rows.where("event_type = 'purchase'"), "user_id", "event_id", "event_id", ["k", "day", "tens"], row=("place",))
    return got.select("event_id", "anchor", "tier", "distance")


@query("""
WITH bins AS (SELECT DISTINCT p_brand, CAST(floor(p_retailprice / 100) * 100 AS DOUBLE) AS place FROM part WHERE p_size > 40)
SELECT p_partkey, p_brand, (SELECT place FROM bins b WHERE b.p_brand = part.p_brand ORDER BY abs(b.place - part.p_retailprice), b.place LIMIT 1) AS nearest FROM part
""")
def nearest_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    headers = part.where("p_size > 40").select("p_brand", (F.floor(F.col("p_retailprice") / 100) * 100).cast("double").alias("at")).distinct()
    cells = part.select("p_partkey", "p_brand", F.col("p_retailprice").alias("at"))
    return matching.nearest_before_and_after(cells, headers, "p_brand", "at", "nearest", ("p_partkey",)).select("p_partkey", "p_brand", "nearest")


LOCATE = """
WITH q AS (SELECT item_id, text AS quote, regexp_replace(lower(text), '[\\s\\-]+', '', 'g') AS pq FROM benchmark WHERE item_id % 4 = 0),
b AS (SELECT doc_id, text, regexp_replace(lower(text), '[\\s\\-]+', '', 'g') AS pb FROM documents)
SELECT item_id, doc_id, CASE WHEN instr(text, quote) > 0 THEN 1 ELSE 2 END AS tier, CAST(CASE WHEN instr(text, quote) > 0 THEN instr(text, quote) ELSE instr(pb, pq) END AS BIGINT) AS position
FROM q JOIN b ON length(pq) > 0 AND contains(pb, pq)
"""


@query(LOCATE.replace("WHERE item_id % 4 = 0", ""))
def evidence_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = matching.located_quotes(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")
    return got.select("item_id", "doc_id", "tier", F.col("position").cast("long").alias("position"))


@query("""
WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS lines FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, round(abs(o_totalprice - lines), 2) AS difference, coalesce(abs(o_totalprice - lines) <= 0.5 * o_totalprice, false) AS supports FROM orders LEFT JOIN s ON o_orderkey = l_orderkey
""")
def tolerance_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("lines"))
    got = matching.supported(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), lines, "o_orderkey", "lines", "o_totalprice", 0.5 * F.col("o_totalprice"))
    return got.select("o_orderkey", F.round("difference", 2).alias("difference"), "supports")


@query("""
WITH g AS (SELECT l_orderkey, count(*) AS n_rows, count(DISTINCT l_returnflag || l_linestatus) AS n, min(l_returnflag) AS f, min(l_linestatus) AS s FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n_rows, CASE WHEN n = 1 THEN f END AS l_returnflag, CASE WHEN n = 1 THEN s END AS l_linestatus, n = 1 AS unanimous FROM g
""")
def unanimous_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unanimous_context(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])


PAIR = """
WITH c AS (SELECT c_custkey AS l, c_nationkey * 1000 + CAST(floor(c_acctbal) AS BIGINT) AS k1, CAST(floor(c_acctbal) AS BIGINT) AS k2 FROM customer), s AS (SELECT s_suppkey AS r, s_nationkey * 1000 + CAST(floor(s_acctbal) AS BIGINT) AS k1, CAST(floor(s_acctbal) AS BIGINT) AS k2 FROM supplier),
t1 AS (SELECT a.l AS left_id, b.r AS right_id FROM (SELECT k1, min(l) AS l FROM c GROUP BY k1 HAVING count(*) = 1) a JOIN (SELECT k1, min(r) AS r FROM s GROUP BY k1 HAVING count(*) = 1) b USING (k1)),
t2 AS (SELECT a.l AS left_id, b.r AS right_id FROM (SELECT k2, min(l) AS l FROM c WHERE l NOT IN (SELECT left_id FROM t1) GROUP BY k2 HAVING count(*) = 1) a JOIN (SELECT k2, min(r) AS r FROM s WHERE r NOT IN (SELECT right_id FROM t1) GROUP BY k2 HAVING count(*) = 1) b USING (k2))
SELECT left_id, right_id, 1 AS tier FROM t1 UNION ALL SELECT left_id, right_id, 2 FROM t2
"""


@query(PAIR)
def tiered_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = lambda c: F.floor(c).cast("long")
    left = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") * 1000 + balance("c_acctbal")).alias("k1"), balance("c_acctbal").alias("k2"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") * 1000 + balance("s_acctbal")).alias("k1"), balance("s_acctbal").alias("k2"))
    return matching.tiered_pairs(left, right, "c_custkey", "s_suppkey", [("k1", "k1"), ("k2", "k2")])


MULTISET = """
WITH l AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS id, l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 1),
r AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS id, l_partkey, l_quantity FROM lineitem WHERE l_linenumber = 2),
ln AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_quantity ORDER BY id) AS n FROM l), rn AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_quantity ORDER BY id) AS n FROM r),
e AS (SELECT ln.id AS left_id, rn.id AS right_id FROM ln JOIN rn USING (l_partkey, l_quantity, n)),
l2 AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY id) AS n FROM l WHERE id NOT IN (SELECT left_id FROM e)), r2 AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY id) AS n FROM r WHERE id NOT IN (SELECT right_id FROM e)),
f AS (SELECT l2.id AS left_id, r2.id AS right_id FROM l2 FULL JOIN r2 ON l2.l_partkey = r2.l_partkey AND l2.n = r2.n)
SELECT outcome, count(*) AS n FROM (SELECT 'exact' AS outcome FROM e UNION ALL SELECT CASE WHEN right_id IS NULL THEN 'missing_right' WHEN left_id IS NULL THEN 'missing_left' ELSE 'equivalent' END FROM f) GROUP BY outcome
"""


@query(MULTISET)
def multiset_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    row_id = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    key = F.concat_ws("|", *[F.col(f"id.{f}").cast("string") for f in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")])
    sides = [rows.where(f"l_linenumber = {n}").select(row_id.alias("id"), "l_partkey", "l_quantity").withColumn("id", key) for n in (1, 2)]
    got = matching.multiset_compare(*sides, "id", "id", ["l_partkey", "l_quantity"], ["l_partkey"])
    return got.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, CASE WHEN n = 1 THEN v END AS c_name FROM supplier LEFT JOIN (SELECT CAST(floor(c_acctbal / 10) AS BIGINT) AS k, count(*) AS n, min(c_name) AS v FROM customer GROUP BY 1) ON CAST(floor(s_acctbal / 10) AS BIGINT) = k")
def related_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "supplier").select("s_suppkey", F.floor(F.col("s_acctbal") / 10).alias("k"))
    right = table(spark, sf_dir, "customer").select(F.floor(F.col("c_acctbal") / 10).alias("k"), "c_name")
    return projection.related_unique(left, right, "k", "c_name").select("s_suppkey", "c_name")


@query("""
WITH h AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS host, nullif(regexp_extract(lower(url), '^[a-z]+://[^/?#]+/([^/?#]+)', 1), '') AS dir FROM pages)
SELECT page_id, coalesce((SELECT min(b.page_id) FROM h b WHERE b.host = h.host), (SELECT min(b.page_id) FROM h b WHERE b.dir = h.dir)) AS canonical_page, CASE WHEN host IS NOT NULL THEN 'host' ELSE 'dir' END AS matched_by FROM h
""")
def or_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.lower("url")
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(url).alias("host"), F.nullif(F.regexp_extract(url, "^[a-z]+://[^/?#]+/([^/?#]+)", 1), F.lit("")).alias("dir"))
    right = rows.select("host", "dir", F.col("page_id").alias("canonical_page"))
    return matching.either_key(rows, right, [("host", "host"), ("dir", "dir")], "canonical_page").select("page_id", "canonical_page", "matched_by")


@query("""
WITH l AS (SELECT o_orderkey AS left_id, o_custkey, o_totalprice AS v FROM orders WHERE o_orderstatus = 'F'), r AS (SELECT o_orderkey AS right_id, o_custkey, o_totalprice AS v FROM orders WHERE o_orderstatus = 'O')
SELECT left_id, right_id FROM l JOIN r ON l.o_custkey = r.o_custkey AND abs(l.v - r.v) <= 5000
""")
def tolerance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    left, right = (rows.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "FO")
    return matching.tolerance_pairs(left, right, ["o_custkey"], "o_totalprice", 5000.0, "o_orderkey", "o_orderkey")


@query("""
WITH s AS (SELECT row_number() OVER (ORDER BY -o_totalprice, o_orderkey) AS place, o_custkey % 1000 AS c_custkey FROM orders),
c AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 9 <> 4),
t AS (SELECT place, s.c_custkey, c_name, row_number() OVER (PARTITION BY s.c_custkey ORDER BY place) AS turn FROM s LEFT JOIN c ON c.c_custkey = s.c_custkey)
SELECT place, c_custkey, CASE WHEN turn = 1 THEN c_name END AS c_name, CASE WHEN c_name IS NULL THEN 'MISSING' WHEN turn > 1 THEN 'REPEATED' ELSE 'FOUND' END AS status FROM t
""")
def frozen_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, in the order of the orders' prices; every ninth customer is in no catalog."""
    from assaylake.operators import ranking

    priced = table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey", (F.col("o_custkey") % 1000).alias("c_custkey"))
    selected = ranking.numbered(priced, "place", F.desc("o_totalprice"), F.col("o_orderkey")).select("place", "c_custkey")
    return matching.frozen_selection(selected, table(spark, sf_dir, "customer").where("c_custkey % 9 != 4").select("c_custkey", "c_name"), "c_custkey")


@query("""
WITH l AS (SELECT l_orderkey AS item, l_partkey * 10 + l_linenumber AS candidate, l_suppkey AS point, l_quantity AS q, row_number() OVER (PARTITION BY l_orderkey, l_suppkey, CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END ORDER BY -l_quantity, l_partkey * 10 + l_linenumber) AS turn FROM lineitem),
m AS (SELECT l.*, CASE item % 5 WHEN 1 THEN 'NO_PLAN' WHEN 2 THEN 'NO_ACCEPTANCE' WHEN 3 THEN 'PLAN_CHANGED' WHEN 4 THEN 'NOT_ACCEPTED' ELSE CASE WHEN turn > 1 THEN 'SUPERSEDED' END END AS reason FROM l)
SELECT item, candidate, point, coalesce(reason, 'MERGED') AS outcome FROM m
""")
def marker_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as marks of an order's picture at a supplier's point: orders lack a plan, an acceptance, or have one for another plan or another verdict."""
    from assaylake.operators import merging

    marks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("candidate"), F.col("l_suppkey").alias("point"), F.col("l_quantity").alias("q"))
    items = marks.select("item").distinct()
    plans = items.where("item % 5 != 1").select("item", F.sha2(F.concat(F.lit("plan"), "item").cast("binary"), 256).alias("plan_sha256"))
    asked = items.where("item % 5 != 2").select("item", F.sha2(F.concat(F.when(F.col("item") % 5 == 3, "older").otherwise("plan"), "item").cast("binary"), 256).alias("plan_sha256"), F.when(F.col("item") % 5 == 4, "REJECTED").otherwise("ACCEPTED").alias("verdict"))
    merged, rejected = merging.accepted_merge(marks, plans, asked, ["item", "point"], F.desc("q"))
    return merged.select("item", "candidate", "point", F.lit("MERGED").alias("outcome")).unionByName(rejected.select("item", "candidate", "point", F.col("reason").alias("outcome")))


@query("""
WITH t AS (SELECT p_partkey AS k, p_size AS s, 2 + p_partkey % 3 AS n FROM part)
SELECT k AS p_partkey, i AS place, 'M' || i AS name, CAST(s * i + 0.5 AS DOUBLE) AS value, 'MPa' AS unit FROM t, range(1, 5) AS r(i) WHERE i <= n AND k % 7 <> 0
""")
def respective_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of two to four names with their values; in every seventh a value is missing."""
    from assaylake.functions import text

    k, n = F.col("p_partkey"), (2 + F.col("p_partkey") % 3).cast("int")
    names = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("M"), i.cast("string")))
    values = F.transform(F.sequence(F.lit(1), n - F.when(k % 7 == 0, 1).otherwise(0)), lambda i: (F.col("p_size") * i + 0.5).cast("string"))
    joined = lambda a: F.when(F.size(a) > 1, F.concat(F.array_join(F.slice(a, F.lit(1), F.size(a) - 1), ", "), F.lit(" and "), F.element_at(a, -1))).otherwise(a[0])
    said = F.concat(F.lit("In 28 days "), joined(names), F.lit(" had strengths of "), joined(values), F.lit(" MPa, respectively."))
    texts = table(spark, sf_dir, "part").select("p_partkey", said.alias("said")).repartition(4 * spark.sparkContext.defaultParallelism)  # few bytes, much work
    rows = texts.select("p_partkey", F.posexplode(text.respective_pairs(F.col("said"))).alias("place", "p"))
    return rows.select("p_partkey", (F.col("place") + 1).alias("place"), "p.*")
