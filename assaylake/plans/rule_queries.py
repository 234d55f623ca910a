"""Small rules over whole tables: keys, times, replacements, overwrites, currency, votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import text
from assaylake.operators import cells, claims, control, merging, pixels
from assaylake.plans.registry import query, table
from assaylake.plans.storage import dealt


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '   ' ELSE repeat(' ', p_size % 4) || p_name || repeat(' ', p_partkey % 3) END AS printed FROM part)
SELECT p_partkey, nullif(trim(printed), '') AS specimen FROM p
""")
def specimen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pad = lambda n: F.repeat(F.lit(" "), n.cast("int"))
    printed = F.when(F.col("p_size") % 7 == 0, "   ").otherwise(F.concat(pad(F.col("p_size") % 4), "p_name", pad(F.col("p_partkey") % 3)))
    return table(spark, sf_dir, "part").select("p_partkey", text.specimen_key(printed).alias("specimen"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(floor(epoch(ts)) AS BIGINT) - CASE event_id % 4 WHEN 1 THEN 7200 WHEN 2 THEN -19800 ELSE 0 END END AS seconds FROM events
""")
def utc_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times printed with Z, with an offset to the east or the west, or without a zone, which is no time."""
    zone = F.element_at(F.array(F.lit("Z"), F.lit("+02:00"), F.lit("-05:30"), F.lit("")), (F.col("event_id") % 4 + 1).cast("int"))
    printed = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), zone)
    return table(spark, sf_dir, "events").select("event_id", F.unix_seconds(text.utc_time(printed)).alias("seconds"))


@query("""
WITH c AS (SELECT p_partkey, 100 - p_size AS c, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS g, p_partkey % 3 AS k FROM part)
SELECT p_partkey, CASE WHEN c + g = 100 AND k <> 2 THEN CAST(c AS DOUBLE) END AS c_share, CASE WHEN c + g = 100 AND k <> 2 THEN CAST(g AS DOUBLE) END AS g_share FROM c
""")
def composition_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities with two or three coded shares, some of which do not add up, and some with other letters behind."""
    code = F.concat(F.lit("C"), 100 - F.col("p_size"), F.lit("G"), F.col("p_size") + F.when(F.col("p_partkey") % 5 == 0, 1).otherwise(0), F.element_at(F.array(F.lit(""), F.lit("U0"), F.lit("-28d")), (F.col("p_partkey") % 3 + 1).cast("int")))
    shares = text.coded_composition(code)
    return table(spark, sf_dir, "part").select("p_partkey", F.try_element_at(shares, F.lit("C")).alias("c_share"), F.try_element_at(shares, F.lit("G")).alias("g_share"))


@query("""
WITH b AS (SELECT l_suppkey AS document, l_linenumber AS page, l_quantity AS x0, l_quantity + 5 AS x1, l_extendedprice AS y0 FROM lineitem),
h AS (SELECT *, CASE WHEN (x0 + x1) / 2 >= (min(x0) OVER (PARTITION BY document, page) + max(x1) OVER (PARTITION BY document, page)) / 2 THEN 1 ELSE 0 END AS half FROM b)
SELECT document, page, x0, y0, CAST(row_number() OVER (PARTITION BY document ORDER BY page, half, y0, x0) AS INTEGER) AS place FROM h
""")
def reading_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.col("l_linenumber").alias("page"), F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 5).alias("x1"), F.col("l_extendedprice").alias("y0"))
    return cells.reading_order(blocks).select("document", "page", "x0", "y0", "place")


@query("SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN upper(c_name) ELSE c_name END AS c_name, CASE WHEN c_nationkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def replaced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    new = old.where("c_nationkey % 4 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return merging.replace_by_key(old.drop("c_nationkey"), new, "c_custkey")


@query("""
SELECT 'kept' AS side, o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0
UNION ALL SELECT 'conflict', o_orderkey, o_orderpriority || '!' FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 AND o_orderkey % 5 = 0
""")
def unequal_overwrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two thirds of the keys, written again with those of even keys: the same, or (every fifth) with another priority."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    held = orders.where("o_orderkey % 3 != 0")
    again = orders.where("o_orderkey % 2 = 0").withColumn("o_orderpriority", F.when((F.col("o_orderkey") % 5 == 0) & (F.col("o_orderkey") % 3 != 0), F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")))
    kept, conflicts = merging.insert_if_equal(held, again, "o_orderkey", "o_orderpriority")
    return kept.select(F.lit("kept").alias("side"), "*").unionByName(conflicts.select(F.lit("conflict").alias("side"), "o_orderkey", "o_orderpriority"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN s_suppkey IS NOT NULL THEN 'new-' || l_suppkey ELSE 'old-' || l_suppkey END AS evidence_key FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) ON s_suppkey = l_suppkey")
def evidence_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("old-"), "l_suppkey").alias("evidence_key"))
    renames = table(spark, sf_dir, "supplier").where("s_nationkey < 10").select(F.concat(F.lit("old-"), "s_suppkey").alias("old_key"), F.concat(F.lit("new-"), "s_suppkey").alias("new_key"))
    return merging.rename_evidence(links, renames, "evidence_key")


@query("""
WITH p AS (SELECT CAST(event_id % 100 AS DOUBLE) AS x, value AS y FROM events WHERE value IS NOT NULL), q AS (SELECT x, y + 1 AS y FROM p)
SELECT DISTINCT x, y FROM (SELECT * FROM p WHERE NOT (x BETWEEN 20 AND 40 AND y BETWEEN 5 AND 60) UNION ALL SELECT * FROM q WHERE x BETWEEN 20 AND 40 AND y BETWEEN 5 AND 60)
""")
def regional_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "events").where("value IS NOT NULL").select((F.col("event_id") % 100).cast("double").alias("x"), F.col("value").alias("y"))
    return merging.patch_region(points, points.withColumn("y", F.col("y") + 1), (20.0, 5.0, 40.0, 60.0))


@query("SELECT doc_id, coalesce(doc_id % 5 <> 0 AND doc_id % 7 <> 0, false) AS current FROM documents")
def artifact_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents registered by the hash of their text; of every fifth the file has changed, of every seventh it is gone."""
    docs = table(spark, sf_dir, "documents")
    digest = lambda c: F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256).alias("sha256")
    files = docs.where("doc_id % 7 != 0").select("doc_id", digest(F.when(F.col("doc_id") % 5 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("."))).otherwise(F.col("text"))))
    return control.current_artifacts(docs.select("doc_id", digest(F.col("text"))), files, "doc_id", "sha256").select("doc_id", "current")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) >= 2 AS stop FROM events")
def repeated_defect_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.repeated_defects(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "user_id", "event_type", "event_id").select("event_id", "stop")


@query("""
WITH p AS (SELECT l_suppkey AS image, CAST(l_quantity * 5 AS INTEGER) AS r, CAST(l_linenumber * 30 AS INTEGER) AS g, CAST(round(l_discount * 100) AS INTEGER) AS b FROM lineitem),
n AS (SELECT image, r // 8 AS br, g // 8 AS bg, b // 8 AS bb, count(*) AS n, quantile_cont(r, 0.5) AS r, quantile_cont(g, 0.5) AS g, quantile_cont(b, 0.5) AS b FROM p GROUP BY ALL)
SELECT image, r, g, b FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY n DESC, br, bg, bb) AS k FROM n) WHERE k = 1
""")
def dominant_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as pixels of a supplier's picture, coloured by quantity, line number and discount."""
    px = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("image"), (F.col("l_quantity") * 5).cast("int").alias("r"), (F.col("l_linenumber") * 30).cast("int").alias("g"), F.round(F.col("l_discount") * 100).cast("int").alias("b"))
    return pixels.dominant_colour(px, "image")


@query("""
WITH v AS (SELECT l_suppkey AS image, l_linenumber AS angle, l_returnflag AS series, count(*) AS n FROM lineitem WHERE l_tax < 0.01 AND l_discount < 0.03 GROUP BY ALL),
s AS (SELECT *, count(*) OVER (PARTITION BY image, angle) AS k FROM v WHERE n >= 2), a AS (SELECT image, count(DISTINCT angle) AS n FROM v GROUP BY image)
SELECT s.image, series, count(*) / a.n AS share FROM s JOIN a USING (image) WHERE k = 1 GROUP BY s.image, series, a.n
""")
def pie_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of low tax and discount as colour votes: a supplier's picture, an angle for each line number, a series for each return flag."""
    votes = table(spark, sf_dir, "lineitem").where("l_tax < 0.01 AND l_discount < 0.03").select(F.col("l_suppkey").alias("image"), F.col("l_linenumber").alias("angle"), F.col("l_returnflag").alias("series"))
    return pixels.pie_share(votes, "image", "angle", "series")


PIXELS = "WITH p AS (SELECT DISTINCT l_suppkey AS image, l_partkey % 40 AS x, CAST(l_quantity AS BIGINT) AS y FROM lineitem WHERE l_returnflag = 'R'), r AS (SELECT *, y - row_number() OVER (PARTITION BY image, x ORDER BY y) AS run FROM p)"


def column_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as pixels of a supplier's picture, one a place: red where the line was returned, else black or nearly red."""
    red = F.col("l_returnflag") == "R"
    px = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("image"), (F.col("l_partkey") % 40).alias("x"), F.col("l_quantity").cast("long").alias("y"), F.when(red, 205).when(F.col("l_returnflag") == "A", 150).otherwise(0).alias("r"))
    return px.groupBy("image", "x", "y").agg(F.max("r").alias("r")).withColumns({"g": F.lit(3), "b": F.lit(0)})


@query(PIXELS + "SELECT image, x, quantile_cont(y, 0.5) AS y FROM (SELECT *, min(run) OVER (PARTITION BY image, x) AS first FROM r) WHERE run = first GROUP BY image, x")
def first_run_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.trace_first_run(column_pixels(spark, sf_dir), (200, 0, 0), 10.0)


@query(PIXELS + "SELECT image, x, CASE WHEN count(DISTINCT run) = 1 THEN quantile_cont(y, 0.5) END AS y, min(y) AS y_min, max(y) AS y_max, CASE WHEN count(DISTINCT run) = 1 THEN 'READ' ELSE 'AMBIGUOUS' END AS status FROM r GROUP BY image, x")
def unambiguous_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.trace_unambiguous(column_pixels(spark, sf_dir), (200, 0, 0), 10.0)


@query("""
WITH p AS (SELECT l_orderkey AS figure, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS panel, ['curve', 'psd', 'xrd', 'ftir', 'bar', 'scatter', 'pie'][1 + l_partkey % 7] AS kind, l_returnflag = 'R' AS v, l_quantity * 10 AS x0, l_discount * 1000 AS y0 FROM lineitem)
SELECT figure, panel, CASE WHEN EXISTS (SELECT 1 FROM p q WHERE q.figure = p.figure AND q.panel <> p.panel AND q.x0 < p.x0 + 40 AND q.x0 + 40 > p.x0 AND q.y0 < p.y0 + 30 AND q.y0 + 30 > p.y0) THEN 'manual'
  WHEN v AND kind IN ('curve', 'psd') THEN 'vector' WHEN kind IN ('curve', 'psd', 'xrd', 'ftir') THEN 'raster' WHEN kind = 'bar' THEN 'bars' WHEN kind = 'scatter' THEN 'markers' ELSE 'manual' END AS backend FROM p
""")
def chart_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as figures with a panel for each line."""
    from pyspark.sql import Window

    kind = F.element_at(F.array(*map(F.lit, ("curve", "psd", "xrd", "ftir", "bar", "scatter", "pie"))), (F.col("l_partkey") % 7 + 1).cast("int"))
    x, y = F.col("l_quantity") * 10, F.col("l_discount") * 1000
    panel = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    panels = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("figure"), panel.alias("panel"), kind.alias("kind"), (F.col("l_returnflag") == "R").alias("has_vectors"), x.alias("x0"), y.alias("y0"), (x + 40).alias("x1"), (y + 30).alias("y1"))
    return cells.chart_backend(panels).select("figure", "panel", "backend")


@query("""
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'string' WHEN 3 THEN 'number' WHEN 4 THEN 'boolean' WHEN 5 THEN 'null' END AS kind FROM events
""")
def json_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every kind from events: their properties, a list, a name, a number, a truth, nothing, and a broken text."""
    from assaylake.functions import json_paths

    said = F.array(F.col("props"), F.concat(F.lit("["), "event_id", F.lit("]")), F.to_json(F.array("event_type")), F.col("value").cast("string"), (F.col("value") > 1).cast("string"), F.lit("null"), F.concat(F.lit("{"), "event_type"))
    one = F.element_at(said, (F.col("event_id") % 7 + 1).cast("int"))
    plain = F.when(F.col("event_id") % 7 == 2, F.regexp_replace(one, r"^\[|\]$", "")).otherwise(one)
    return table(spark, sf_dir, "events").select("event_id", json_paths.value_kind(plain).alias("kind"))


def crossref_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search page for each customer with an item for each order; every fifth page has no items, and every seventh is cut off."""
    k, year = F.col("o_orderkey"), F.year("o_orderdate")
    date = lambda y, *more: F.struct(F.array(F.array(y, *map(F.lit, more))).alias("date-parts"))
    pdf = F.when(k % 2 == 0, F.struct(F.concat(F.lit("https://h.org/"), k, F.lit(".pdf")).alias("URL"), F.lit("application/pdf").alias("content-type"))).otherwise(F.struct(F.lit("https://h.org/x").alias("URL"), F.lit("text/html").alias("content-type")))
    cc = F.struct(F.lit("https://creativecommons.org/licenses/by/4.0/").alias("URL"), F.lit("vor").alias("content-version"), date(F.when(k % 3 == 1, 2999).otherwise(2020), 2).alias("start"))
    closed = F.struct(F.lit("https://h.org/terms").alias("URL"), F.lit("vor").alias("content-version"), date(F.lit(2000)).alias("start"))
    item = F.struct(
        F.concat(F.lit("10.1234/X"), k).alias("DOI"), F.array("o_orderpriority").alias("title"), F.array(F.struct(F.lit("A").alias("given"), F.concat(F.lit("B"), "o_custkey").alias("family"))).alias("author"), date(year, 5).alias("issued"),
        F.when(F.col("o_orderstatus") == "P", date(year + 1)).alias("published-print"), F.array(pdf).alias("link"), F.array(F.when(k % 3 == 2, closed).otherwise(cc)).alias("license"), F.concat(F.lit("https://h.org/"), k).alias("URL"),
    )
    pages = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(F.struct(F.collect_list(item).alias("items")).alias("message"))).alias("payload"))
    return pages.withColumn("payload", F.when(F.col("o_custkey") % 5 == 0, '{"message": {"total": 0}}').when(F.col("o_custkey") % 7 == 0, F.expr("left(payload, 40)")).otherwise(F.col("payload")))


@query("""
SELECT o_custkey, '10.1234/x' || o_orderkey AS doi, o_orderpriority AS title, 'A B' || o_custkey AS author, CAST(year(o_orderdate) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS year, 'https://h.org/' || o_orderkey AS landing_url,
  CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'https://h.org/' || o_orderkey || '.pdf' END AS fulltext_url, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'OPEN_FULLTEXT_CANDIDATE' ELSE 'UNRESOLVED' END AS access_status
FROM orders WHERE o_custkey % 5 <> 0 AND o_custkey % 7 <> 0
""")
def crossref_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assaylake.sources import discovery

    good, _ = discovery.split_envelopes(crossref_pages(spark, sf_dir), "payload", discovery.CROSSREF, "message.items")
    found = discovery.crossref(good, F.lit("2024-01-01").cast("date"))
    return found.select("o_custkey", "doi", "title", F.get("authors", 0).alias("author"), "year", "landing_url", "fulltext_url", "access_status")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 5 = 0 OR o_custkey % 7 = 0")
def rejected_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assaylake.sources import discovery

    return discovery.split_envelopes(crossref_pages(spark, sf_dir), "payload", discovery.CROSSREF, "message.items")[1].select("o_custkey")


@query("""
SELECT o_custkey, '10.1234/z' || o_orderkey AS doi, 'W' || o_orderkey AS openalex_id, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'https://a.org/' || o_orderkey WHEN o_orderkey % 5 = 0 THEN 'https://b.org/' || o_orderkey END AS fulltext_url,
  CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 5 = 0 THEN 'OPEN_FULLTEXT_CANDIDATE' ELSE 'UNRESOLVED' END AS access_status FROM orders
""")
def openalex_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works with two locations: the first is open for even orders and has a document for every third, the second is open with one for every fifth."""
    from assaylake.sources import discovery

    k = F.col("o_orderkey")
    place = lambda host, open_, has: F.struct(open_.alias("is_oa"), F.when(has, F.concat(F.lit(f"https://{host}.org/"), k)).alias("pdf_url"), F.concat(F.lit(f"https://{host}.org/"), k, F.lit("/view")).alias("landing_page_url"))
    work = F.struct(
        F.concat(F.lit("W"), k).alias("id"), F.concat(F.lit("https://doi.org/10.1234/Z"), k).alias("doi"), F.col("o_orderpriority").alias("title"), F.year("o_orderdate").alias("publication_year"),
        F.array(F.struct(F.struct(F.concat(F.lit("N"), "o_custkey").alias("display_name")).alias("author"))).alias("authorships"), F.array(place("a", k % 2 == 0, k % 3 == 0), place("b", F.lit(True), k % 5 == 0)).alias("locations"),
    )
    pages = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(work).alias("results"))).alias("payload"))
    found = discovery.openalex(discovery.split_envelopes(pages, "payload", discovery.OPENALEX, "results")[0])
    return found.select("o_custkey", "doi", "openalex_id", "year", "fulltext_url", "access_status")


@query("""
WITH s AS (SELECT p_partkey, lower(p_name) || CASE p_size % 4 WHEN 0 THEN ' paste' WHEN 1 THEN ' mortar bars' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN ', Concrete' ELSE ' pastel' END AS t FROM part),
n AS (SELECT p_partkey, regexp_matches(t, '\\bpaste\\b') AS a, regexp_matches(t, '\\bmortar\\b') AS b, regexp_matches(lower(t), '\\bconcrete\\b') AS c FROM s)
SELECT p_partkey, CASE WHEN a::INT + b::INT + c::INT = 1 THEN CASE WHEN a THEN 'paste' WHEN b THEN 'mortar' ELSE 'concrete' END END AS specimen FROM n
""")
def specimen_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with words for one kind of specimen, for two, or for none."""
    first = F.when(F.col("p_size") % 4 == 0, " paste").when(F.col("p_size") % 4 == 1, " mortar bars").otherwise("")
    said = F.concat("p_name", first, F.when(F.col("p_partkey") % 3 == 0, ", Concrete").otherwise(" pastel"))
    return table(spark, sf_dir, "part").select("p_partkey", text.specimen_type(said).alias("specimen"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag <> 'R', l_linenumber, l_partkey) AS k FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, max(l_returnflag) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey) AS l_returnflag FROM lineitem)) WHERE k = 1")
def stable_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned line of an order, else its first; a line's key is its number and part."""
    from assaylake.operators import ranking

    flag = F.col("l_returnflag")
    rank = F.when(flag > "R", 2).when(flag == "R", 1).when(flag.isNotNull(), 0)  # a number is folded in place; a text would be sorted
    rows = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rank.alias("rank")), "l_orderkey")
    rows = rows.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.max("rank").alias("rank")).withColumn("key", F.struct("l_linenumber", "l_partkey"))
    return ranking.labelled_first(rows, "l_orderkey", F.col("rank") == 1, "key").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
WITH h AS (SELECT l_orderkey AS g, l_linenumber AS page, CASE l_returnflag WHEN 'R' THEN 'methods' WHEN 'A' THEN 'results' END AS t FROM lineitem),
a AS (SELECT g, min(page) AS a FROM h WHERE t = 'methods' GROUP BY g), b AS (SELECT h.g, a, min(page) AS b FROM h JOIN a ON h.g = a.g WHERE t = 'results' AND page >= a GROUP BY h.g, a)
SELECT g AS l_orderkey, CAST(unnest(range(a, b + 1)) AS INTEGER) AS page FROM b WHERE b - a < 3
""")
def page_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as headings of an order's pages: from the first returned one to the next accepted one, three pages at most."""
    from assaylake.operators import ranking

    title = F.when(F.col("l_returnflag") == "R", "Methods").when(F.col("l_returnflag") == "A", "Results").otherwise("other")
    headings = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("page"), title.alias("title"))
    return ranking.page_span(headings, "l_orderkey", "page", F.col("title"), "methods", "results", most=3)


@query("""
WITH c AS (SELECT l_orderkey AS t, count(DISTINCT l_partkey % 5) AS n FROM lineitem WHERE l_partkey % 5 < 3 GROUP BY l_orderkey),
f AS (SELECT o_custkey AS document, o_orderkey AS table_id FROM orders JOIN c ON t = o_orderkey WHERE n >= 2 AND o_orderpriority LIKE '1%')
SELECT document, table_id, CASE WHEN count(*) OVER (PARTITION BY document) = 1 THEN 'SELECTED' ELSE 'AMBIGUOUS' END AS status FROM f
""")
def selected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables of a customer whose caption is urgent and that hold two known labels among their parts."""
    captions = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("document"), F.col("o_orderkey").alias("table_id"), F.concat(F.lit("Table of "), "o_orderpriority").alias("caption"))
    grid = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.concat(F.lit("L"), F.col("l_partkey") % 5).alias("text"))
    return cells.one_table(captions, grid, "(?i)^table of 1", spark.createDataFrame([("L0",), ("L1",), ("L2",)], "label string"), least=2)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_returnflag = 'R', false) OR l_linenumber % 4 = 1 OR l_partkey % 5 = 2 OR l_suppkey % 6 = 3 AS waits FROM lineitem
""")
def repair_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as fields that are blocked, in a state of repair, under its code, or whose reason says so."""
    from assaylake.operators import review

    status = F.when(F.col("l_linenumber") % 4 == 1, review.REPAIR_STATES[0]).otherwise("reported")
    code = F.when(F.col("l_partkey") % 5 == 2, review.REPAIR_CODES[1]).otherwise("OK")
    reason = F.when(F.col("l_suppkey") % 6 == 3, F.concat(F.lit("x "), F.lit(review.REPAIR_WORD)))
    waits = review.waits_for_repair(F.when(F.col("l_returnflag") != "A", F.col("l_returnflag") == "R"), status, code, F.lit(None).cast("string"), reason)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", waits.alias("waits"))


@query("""
WITH s AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'H₂O₂ ' || p_size || '%' WHEN 1 THEN 'SPC powder' WHEN 2 THEN 'h2o2 and spc' WHEN 3 THEN 'h2o2x' ELSE p_name END AS t FROM part),
n AS (SELECT p_partkey, lower(translate(t, '₀₁₂₃₄₅₆₇₈₉', '0123456789')) AS t FROM s), m AS (SELECT p_partkey, regexp_matches(t, '(^|[^a-z0-9_])h2o2([^a-z0-9_]|$)') AS a, regexp_matches(t, '(^|[^a-z0-9_])spc([^a-z0-9_]|$)') AS b FROM n)
SELECT p_partkey, CASE WHEN a AND NOT b THEN 'h2o2' WHEN b AND NOT a THEN 'spc' ELSE 'foaming_agent' END AS agent FROM m
""")
def foaming_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    said = F.when(k == 0, F.concat(F.lit("H₂O₂ "), "p_size", F.lit("%"))).when(k == 1, "SPC powder").when(k == 2, "h2o2 and spc").when(k == 3, "h2o2x").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.foaming_agent(said).alias("agent"))


@query("SELECT p_partkey, 'A paste; N' || p_size || '; B' || CASE WHEN p_partkey % 3 = 0 THEN '; extra A' ELSE '' END AS shown FROM part")
def replaced_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of segments with terms of which one begins another, and with segments that come twice."""
    from assaylake.functions import display

    said = F.concat(F.lit("alpha paste; N"), "p_size", F.lit(";alphabet ; alpha paste"), F.when(F.col("p_partkey") % 3 == 0, "; extra alpha").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", display.replace_terms(said, {"alpha": "A", "alphabet": "B"}).alias("shown"))


@query("""
WITH m AS (SELECT l_suppkey AS page, l_orderkey * 10 + l_linenumber AS marker, l_quantity AS x, l_discount * 100 AS y, l_linenumber AS dx, l_partkey % 11 AS dy FROM lineitem)
SELECT page, marker, x, round(y, 3) AS y, count(*) OVER (PARTITION BY dx, dy) AS n FROM m
""")
def copied_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as marks of two points; marks of one shape are copies wherever they stand."""
    x, y = F.col("l_quantity").cast("double"), (F.col("l_discount") * 100).cast("double")
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    marks = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("marker"), F.array(point(x + F.col("l_linenumber"), y + F.col("l_partkey") % 11), point(x, y)).alias("points"))
    return pixels.translated_copies(marks).select("page", "marker", "x", F.round("y", 3).alias("y"), "n")


@query(r"""
WITH h AS (SELECT p_partkey, ['Si O₂', 'Al2 O3', 'LOI a', 'Fe2O3 + Ca O', 'Others', 'Mix ' || p_size, 'K₂O', 'loi'][1 + p_partkey % 8] AS h FROM part),
l AS (SELECT p_partkey, translate(regexp_replace(h, '\s+', '', 'g'), '₀₁₂₃₄₅₆₇₈₉', '0123456789') AS plain FROM h),
o AS (SELECT p_partkey, CASE WHEN regexp_matches(plain, '^LOI[a-z*†‡]$') THEN 'LOI' ELSE plain END AS label FROM l)
SELECT p_partkey, label, regexp_matches(label, '^([A-Z][a-z]?[0-9]*O[0-9]*(\+[A-Z][a-z]?[0-9]*O[0-9]*)*|LOI|Others?)$') AS is_component FROM o
""")
def oxide_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.lit("Si O₂"), F.lit("Al2 O3"), F.lit("LOI a"), F.lit("Fe2O3 + Ca O"), F.lit("Others"), F.concat(F.lit("Mix "), "p_size"), F.lit("K₂O"), F.lit("loi"))
    header = F.element_at(names, (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.oxide_label(header).alias("label"), text.is_component(header).alias("is_component"))
