"""Ordered scans, rankings and review projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.functions import urls
from assaylake.operators import projection, ranking, windows
from assaylake.plans.registry import query, table

CURVE = """
c AS (SELECT l_suppkey, d AS x, 100.0 * sum(q) OVER (PARTITION BY l_suppkey ORDER BY d ROWS UNBOUNDED PRECEDING) / sum(q) OVER (PARTITION BY l_suppkey) AS y
  FROM (SELECT l_suppkey, CAST(date_diff('day', TIMESTAMP '1990-01-01', l_shipdate) AS DOUBLE) AS d, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2))
"""


def cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cumulative curve of quantity over ship day for each supplier."""
    day = F.datediff(F.col("l_shipdate"), F.lit("1990-01-01")).cast("double")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", day.alias("x")).agg(F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("l_suppkey")
    run = F.sum("q").over(w.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("l_suppkey", "x", (100.0 * run / F.sum("q").over(w)).alias("y"))


@query(f"""
WITH {CURVE}, n AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY x)), p AS (SELECT unnest([10.0, 50.0, 90.0]) AS p),
h AS (SELECT l_suppkey, p, count(*) FILTER (WHERE abs(y - p) <= 1e-9) AS e, max(CASE WHEN abs(y - p) <= 1e-9 THEN x END) AS ex, count(*) FILTER (WHERE y < p AND p < y1) AS k,
  max(CASE WHEN y < p AND p < y1 THEN x + (p - y) / (y1 - y) * (x1 - x) END) AS cx FROM n, p GROUP BY 1, 2)
SELECT l_suppkey, CAST(p AS DOUBLE) AS p, round(CASE WHEN e = 1 THEN ex WHEN e = 0 AND k = 1 THEN cx END, 4) AS x_value FROM h
""")
def percentile_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = windows.percentile_crossings(cumulative(spark, sf_dir), "l_suppkey", "x", "y")
    return got.withColumn("x_value", F.round("x_value", 4))


@query(f"""
WITH {CURVE}, n AS (SELECT *, lead(y) OVER w - y AS dy, lead(x) OVER w - x AS dx, y < 99 AND lead(y) OVER w > 1 AS core FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY x))
SELECT l_suppkey, count(*) AS n_points, count(*) >= 5 AND arg_min(y, x) <= 1 AND arg_max(y, x) >= 99 AND max(dy) <= 25 AND max(CASE WHEN core THEN dx END) <= 0.25 * (max(x) - min(x)) AS covered FROM n GROUP BY 1
""")
def curve_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.curve_coverage(cumulative(spark, sf_dir), "l_suppkey", "x", "y")


@query(f"""
WITH {CURVE}, n AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, max(x) OVER (PARTITION BY l_suppkey) - min(x) OVER (PARTITION BY l_suppkey) AS wd FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY x, y))
SELECT l_suppkey, CAST(50.0 AS DOUBLE) AS p, round(CASE WHEN count(*) FILTER (WHERE y <= 50 AND 50 < y1) = 1 THEN max(CASE WHEN y <= 50 AND 50 < y1 AND x1 - x <= 0.08 * wd THEN x + (50 - y) / (y1 - y) * (x1 - x) END) END, 4) AS x_value, round(CASE WHEN count(*) FILTER (WHERE y <= 50 AND 50 < y1) = 1 THEN max(CASE WHEN y <= 50 AND 50 < y1 AND x1 - x <= 0.08 * wd THEN x END) - 0.5 END, 4) AS x_low, round(CASE WHEN count(*) FILTER (WHERE y <= 50 AND 50 < y1) = 1 THEN max(CASE WHEN y <= 50 AND 50 < y1 AND x1 - x <= 0.08 * wd THEN x1 END) + 0.5 END, 4) AS x_high FROM n GROUP BY 1
""")
def vector_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = windows.vector_percentile(cumulative(spark, sf_dir), "l_suppkey", "x", "y", 50.0, pad=0.5)
    return got.withColumns({c: F.round(c, 4) for c in ("x_value", "x_low", "x_high")})


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (
  SELECT user_id, n, [value] AS ys, [CAST(1 AS BIGINT)] AS best, [CAST(0 AS BIGINT)] AS back FROM e WHERE n = 1
  UNION ALL
  SELECT user_id, n, list_append(ys, value), list_append(best, 1 + list_max(f)), list_append(back, CASE WHEN list_max(f) = 0 THEN 0 ELSE CAST(list_position(f, list_max(f)) AS BIGINT) END)
  FROM (SELECT e.user_id, e.n, r.ys, r.best, r.back, e.value, list_transform(range(1, len(r.ys) + 1), lambda j: CASE WHEN e.value <= r.ys[j] + 1.0 THEN r.best[j] ELSE 0 END) AS f FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
),
w AS (SELECT user_id, best, back FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS z FROM r) WHERE z = 1),
p AS (SELECT user_id, back, CAST(list_position(best, list_max(best)) AS BIGINT) AS place FROM w UNION ALL SELECT user_id, back, back[place] FROM p WHERE back[place] > 0)
SELECT e.event_id, e.user_id, p.place IS NOT NULL AS kept FROM e LEFT JOIN p ON p.user_id = e.user_id AND p.place = e.n
""")
def monotone_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return windows.monotone_path(rows, "user_id", ["ts", "event_id"], "value", 1.0).select("event_id", "user_id", "kept")


@query("""
WITH b AS (SELECT event_id, user_id, value AS y0, value + 0.5 AS y1 FROM events), m AS (SELECT *, max(y1) OVER (PARTITION BY user_id ORDER BY y0, y1, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b)
SELECT event_id, CAST(sum(CASE WHEN before IS NULL OR y0 > before + 1.0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY y0, y1, event_id) AS BIGINT) AS band FROM m
""")
def band_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").alias("y0"), (F.col("value") + 0.5).alias("y1"))
    return windows.band_clusters(boxes, "user_id", "y0", "y1", 1.0, "event_id").select("event_id", "band")


@query("""
WITH s AS (SELECT event_id, user_id, ts, coalesce(epoch(ts) - epoch(lag(ts) OVER w), 0) > 43200 AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch(ts), event_id))
SELECT event_id, CAST(sum(cut::INT) OVER (PARTITION BY user_id ORDER BY epoch(ts), event_id) + 1 AS BIGINT) AS segment FROM s
""")
def segment_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return windows.gap_segments(rows, "user_id", "at", 43200.0, "event_id").select("event_id", "segment")


@query("""
WITH d AS (SELECT DISTINCT o_custkey, o_orderkey // 50 AS v FROM orders), i AS (SELECT *, v - row_number() OVER (PARTITION BY o_custkey ORDER BY v) AS g FROM d)
SELECT o_custkey, min(v) AS run_start, max(v) AS run_end, count(*) AS n FROM i GROUP BY o_custkey, g
""")
def int_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.floor(F.col("o_orderkey") / 50).cast("long").alias("v"))
    return windows.integer_runs(rows, "o_custkey", "v")


@query("""
WITH r AS (SELECT event_id, user_id, ts, value, CAST(floor(value) AS BIGINT) AS page FROM events),
s AS (SELECT *, count(*) OVER w AS run_requests, sum(value) OVER w AS run_bytes, row_number() OVER w AS place, row_number() OVER (PARTITION BY user_id, page ORDER BY ts, event_id) AS again FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
t AS (SELECT *, CASE WHEN run_requests >= 20 THEN 'BUDGET_REQUESTS' WHEN run_bytes >= 700 THEN 'BUDGET_BYTES' WHEN again > 1 THEN 'REPEATED_PAGE' END AS stop_reason FROM s),
f AS (SELECT *, min(CASE WHEN stop_reason IS NOT NULL THEN place END) OVER (PARTITION BY user_id) AS first FROM t)
SELECT event_id, user_id, CAST(place AS INT) AS place, stop_reason FROM f WHERE first IS NULL OR place <= first
""")
def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.lit(1).alias("requests"), F.col("value").alias("bytes"), F.floor("value").alias("page"))
    got = windows.budget_prefix(rows, "user_id", ["ts", "event_id"], {"requests": 20, "bytes": 700}, "page")
    return got.select("event_id", "user_id", "place", "stop_reason")


@query("""
SELECT conv_id, turn, lag(role) OVER w IS DISTINCT FROM CASE WHEN role = 'assistant' THEN 'user' WHEN turn = 0 THEN NULL ELSE 'assistant' END AS broken FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.when(F.col("role") == "assistant", "user").when(F.col("turn") != 0, "assistant")
    rows = table(spark, sf_dir, "conversations").withColumn("after", after)
    return windows.chain_defects(rows, "conv_id", "turn", "role", "after").select("conv_id", "turn", "broken")


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS n FROM events),
r AS (SELECT event_id, user_id, n, value AS leader, CAST(1 AS BIGINT) AS band FROM e WHERE n = 1 UNION ALL SELECT e.event_id, e.user_id, e.n, CASE WHEN abs(e.value - r.leader) > 2 THEN e.value ELSE r.leader END, r.band + CASE WHEN abs(e.value - r.leader) > 2 THEN 1 ELSE 0 END FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT event_id, band FROM r
""")
def leader_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return windows.leader_bands(rows, "user_id", ["value", "event_id"], "value", 2.0).select("event_id", "band")


@query("SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) AS INT) AS rank FROM orders ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey LIMIT 100")
def topk_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("o_totalprice"), F.desc("o_orderdate"), "o_orderkey"]
    return ranking.ranked(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), order, 100).select("o_orderkey", "o_totalprice", "rank")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 30 OFFSET 30")
def offset_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 30, 30)


@query("""
WITH h AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS host FROM pages), t AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS turn FROM h)
SELECT page_id, host, CAST(row_number() OVER (ORDER BY turn, page_id) AS INT) AS pick FROM t ORDER BY turn, page_id LIMIT 60
""")
def diverse_pool_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return ranking.spread_hosts(rows, "host", ["page_id"], 60).select("page_id", "host", "pick")


@query("""
WITH RECURSIVE d AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS place, count(*) OVER (PARTITION BY source) AS n FROM documents),
r AS (
  SELECT source, CAST(0 AS BIGINT) AS place, CAST(-1 AS BIGINT) AS doc_id, list_transform(range(least(4, n)), lambda x: CAST(0 AS BIGINT)) AS loads, CAST(0 AS BIGINT) AS shard FROM d WHERE d.place = 1
  UNION ALL
  SELECT source, place, doc_id, list_concat(list_append(loads[1:shard], loads[shard + 1] + n_chars), loads[shard + 2:]), shard
  FROM (SELECT r.source, d.place, d.doc_id, d.n_chars, r.loads, list_position(r.loads, list_min(r.loads)) - 1 AS shard FROM r JOIN d ON d.source IS NOT DISTINCT FROM r.source AND d.place = r.place + 1)
)
SELECT doc_id, CAST(shard AS BIGINT) AS shard FROM r WHERE place > 0
""")
def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.balanced_shards(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", "n_chars", 4, "source")


@query("SELECT o_orderkey, least((row_number() OVER (ORDER BY o_orderkey) - 1) // greatest(1, (SELECT count(*) FROM orders) // 7), 6) AS shard FROM orders")
def even_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.even_shards(table(spark, sf_dir, "orders"), "o_orderkey", 7)


@query("SELECT doc_id, source, CAST(ceil(row_number() OVER (PARTITION BY source ORDER BY doc_id) / 2.0) AS BIGINT) AS pair FROM documents")
def small_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.pairs_of_two(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("""
WITH s AS (SELECT *, CASE WHEN role = 'user' THEN true WHEN role = 'system' THEN false END AS sw FROM conversations),
o AS (SELECT *, last_value(sw IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS o FROM s)
SELECT conv_id, turn, role FROM o WHERE o
""")
def reading_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return projection.reading_scope(rows, "conv_id", "turn", F.col("role") == "user", F.col("role") == "system").select("conv_id", "turn", "role")


@query("""
SELECT l_orderkey, coalesce(string_agg(q, '; ' ORDER BY q) FILTER (WHERE l_returnflag = 'A'), '') AS "A", coalesce(string_agg(q, '; ' ORDER BY q) FILTER (WHERE l_returnflag = 'N'), '') AS "N", coalesce(string_agg(q, '; ' ORDER BY q) FILTER (WHERE l_returnflag = 'R'), '') AS "R"
FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem) GROUP BY l_orderkey
""")
def field_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    return projection.matrix(rows, "l_orderkey", "l_returnflag", "q", ["A", "N", "R"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, n_seen FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER w AS r, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_seen FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice)) WHERE r = 1
""")
def observation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = projection.distinct_observations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return got.select("l_orderkey", "l_linenumber", "l_partkey", "n_seen")


@query("""
WITH p AS (SELECT user_id, ts, event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 OR value > 90 THEN 'M' ELSE 'L' END || event_id || ',' || CAST(floor(value) AS BIGINT) AS s FROM events)
SELECT user_id, string_agg(s, ' ' ORDER BY ts, event_id) AS path FROM p GROUP BY user_id
""")
def path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.floor("value").cast("long").alias("y"), (F.col("value") > 90).alias("gap"))
    return projection.path_text(rows.withColumn("x", F.col("event_id")), "user_id", ["ts", "event_id"], "x", "y", "gap")


@query("""
SELECT event_id, CASE WHEN event_type IN ('purchase', 'click') AND user_id % 3 <> 0 THEN 'extensions' WHEN event_type IN ('purchase', 'click', 'view') THEN event_type ELSE 'reported_observations' END AS destination FROM events
""")
def route_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("user_id") % 3 == 0, "mix").otherwise("mat").alias("owner_kind"))
    return projection.route_facts(rows, "event_type", "owner_kind", ("purchase", "click"), ("purchase", "click", "view")).select("event_id", "destination")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS \"index\" FROM orders")
def numbered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = projection.numbered(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", ["o_orderdate", "o_orderkey"])
    return got.select("o_orderkey", F.col("index").cast("long").alias("index"))
