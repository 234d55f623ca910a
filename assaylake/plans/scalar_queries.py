"""Projections and scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import json_paths, text, transforms, units, urls
from assaylake.operators import scoring
from assaylake.plans.registry import query, spread, table

LETTERS = "regexp_replace(replace(lower(text), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g')"


@query(f"SELECT doc_id, trim({LETTERS}) AS title_key FROM documents")
def doc_title_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.title_key(F.col("text")).alias("title_key"))


@query("SELECT doc_id, nullif(rtrim(regexp_extract(lower(text), '10\\.[0-9]{4,9}/[-._;()/:a-z0-9]+'), '.,;)'), '') AS doi FROM documents")
def doi_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.doi(F.col("text")).alias("doi"))


RULES_SQL = """
WITH w AS (SELECT doc_id, replace(lower(text), 'ß', 'ss') AS t, n_chars FROM documents),
p AS (SELECT doc_id,
  CASE WHEN regexp_matches(t, '\\bqxrd\\b|rietveld|quantitative x[- ]ray|amorphous') THEN 30 ELSE 0 END
  + CASE WHEN regexp_matches(t, 'mix proportion|mixture proportion|compressive strength|flexural strength|mortar|paste') THEN 20 ELSE 0 END
  + CASE WHEN regexp_matches(t, 'particle size|\\bpsd\\b|d10|d50|d90') THEN 15 ELSE 0 END
  + CASE WHEN regexp_matches(t, '\\bxrf\\b|x[- ]ray fluorescence|chemical composition') THEN 15 ELSE 0 END
  + CASE WHEN regexp_matches(t, 'ft[- ]?ir|nmr|sem|eds|tga|calorim|xrd') THEN 8 ELSE 0 END AS content,
  CASE WHEN n_chars >= 2018 THEN 5 ELSE 0 END AS recent FROM w)
SELECT doc_id, CAST(content + recent AS BIGINT) AS score, CAST(content AS BIGINT) AS content_score FROM p
"""


@query(RULES_SQL)
def rule_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = scoring.literature_rules(F.col("text"), F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit(None).cast("string"), F.col("n_chars"))
    told = table(spark, sf_dir, "documents").withColumn("why", scoring.explanation(rules))
    return told.select("doc_id", scoring.total(F.col("why")).cast("long").alias("score"), scoring.total(F.col("why"), "Accessible/recent").cast("long").alias("content_score"))


@query("SELECT event_id, event_type, user_id FROM events WHERE coalesce(year(ts) BETWEEN 2024 AND 2024, false) AND event_type IN ('purchase', 'click') AND json_extract_string(props, '$.k') IS NOT NULL")
def candidate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    in_range = F.coalesce(F.year("ts").between(2024, 2024), F.lit(False))
    return rows.where(in_range & F.col("event_type").isin("purchase", "click") & json_paths.read(F.col("props"), "/k").isNotNull()).select("event_id", "event_type", "user_id")


URL = "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#@]*@)?([^/?#:@]+)(?::([0-9]*))?(/[^?#]*)?(\\?[^#]*)?(#.*)?$"


@query(f"""
WITH p AS (SELECT page_id, regexp_extract(trim(url), '{URL}', ['scheme', 'who', 'host', 'port', 'path', 'query', 'frag']) AS u FROM pages)
SELECT page_id, nullif(lower(u.host), '') AS host,
  CASE WHEN lower(u.scheme) = 'https' AND u.who = '' AND u.host <> '' THEN 'https://' || lower(u.host) || CASE WHEN u.port IN ('', '443') THEN '' ELSE ':' || u.port END
    || CASE WHEN u.path = '' THEN '/' ELSE u.path END || CASE WHEN u.query = '?' THEN '' ELSE u.query END END AS canonical
FROM p
""")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.canonical_https(F.col("url")).alias("canonical"))


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS value,
  CASE WHEN l_linenumber % 3 = 0 THEN 'specific_surface_m2_kg' WHEN l_linenumber % 3 = 1 THEN 'age_seconds' ELSE 'bulk_density_kg_m3' END AS name,
  CASE WHEN l_linenumber % 3 = 0 THEN 'cm²/g' WHEN l_linenumber % 3 = 1 THEN 'd' ELSE 'lb' END AS unit FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, name,
  CASE WHEN unit = 'cm²/g' THEN 'm2/kg' WHEN unit = 'd' THEN 's' ELSE 'lb' END AS target_unit,
  round(value * CASE WHEN unit = 'cm²/g' THEN 0.1 WHEN unit = 'd' THEN 86400.0 ELSE 1.0 END, 4) AS converted, round(value, 4) AS reverse
FROM v
""")
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("l_linenumber") % 3
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").alias("value"), F.lit("field").alias("kind"),
        F.when(third == 0, "specific_surface_m2_kg").when(third == 1, "age_seconds").otherwise("bulk_density_kg_m3").alias("name"), F.when(third == 0, "cm²/g").when(third == 1, "d").otherwise("lb").alias("unit"),
    )
    return units.convert(rows).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "name", "target_unit", F.round("converted", 4).alias("converted"), F.round("reverse", 4).alias("reverse"))


TRANSFORM = """
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 7 AS fault,
    ['unit_scale', 'binary_mass_complement_percent', 'ratio_to_fraction_percent', 'linear_axis_coordinate', 'log_axis_percentile', 'ratio_component', 'linear_pixel_y', 'duration_sequence_to_seconds', 'folklore'][1 + l_orderkey % 9] AS kind
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, kind, CASE
  WHEN fault = 5 THEN 'TRANSFORM_NOT_FORMAL_OR_FORMULA_MISSING'
  WHEN fault = 6 AND kind = 'binary_mass_complement_percent' THEN 'INVALID_BINARY_MASS_BASIS'
  WHEN fault = 6 AND kind = 'ratio_to_fraction_percent' THEN 'INVALID_STANDARD_RATIO'
  WHEN fault = 6 AND kind = 'linear_axis_coordinate' THEN 'INVALID_LINEAR_AXIS'
  WHEN kind = 'folklore' THEN CASE WHEN fault IN (1, 3) THEN 'FORWARD_RECEIPT_DRIFT,' WHEN fault = 4 THEN 'REVERSE_RECEIPT_MISSING,' ELSE '' END || 'UNKNOWN_TRANSFORM_KIND:folklore'
  WHEN fault IN (0, 6) THEN ''
  WHEN fault = 2 THEN 'TRANSFORM_OUTPUT_RECORD_DRIFT'
  WHEN fault = 3 THEN 'FORWARD_RECEIPT_DRIFT'
  WHEN kind = 'ratio_component' THEN CASE WHEN fault = 1 THEN 'FORWARD_RECOMPUTE_FAILED,TRANSFORM_OUTPUT_RECORD_DRIFT' ELSE 'REVERSE_RECOMPUTE_FAILED' END
  WHEN fault = 1 THEN 'FORWARD_RECEIPT_DRIFT,FORWARD_RECOMPUTE_FAILED,' || CASE WHEN kind IN ('binary_mass_complement_percent', 'ratio_to_fraction_percent', 'linear_axis_coordinate') THEN 'REVERSE_RECEIPT_DRIFT,' ELSE '' END || 'REVERSE_RECOMPUTE_FAILED,TRANSFORM_OUTPUT_RECORD_DRIFT'
  WHEN kind IN ('binary_mass_complement_percent', 'linear_axis_coordinate') THEN 'REVERSE_RECEIPT_DRIFT,REVERSE_RECEIPT_MISSING'
  WHEN kind = 'ratio_to_fraction_percent' THEN 'REVERSE_RECEIPT_MISSING,REVERSE_RECOMPUTE_FAILED'
  ELSE 'REVERSE_RECEIPT_MISSING' END AS defects
FROM r
"""


@query(TRANSFORM)
def transform_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of every kind from the lines' quantities, sound or with one of six faults."""
    kinds = F.array(*map(F.lit, (transforms.SCALE, transforms.COMPLEMENT, transforms.FRACTION, transforms.LINEAR, transforms.LOG, transforms.COMPONENT, transforms.PIXEL, transforms.DURATIONS, "folklore")))
    kind, fault, v = kinds[(F.col("l_orderkey") % 9).cast("int")], F.col("l_linenumber") % 7, F.col("l_quantity").cast("double")
    many, bad = kind == transforms.DURATIONS, fault == 6
    doubles = lambda *x: F.array(*[c if hasattr(c, "cast") else F.lit(float(c)) for c in x])
    positions = F.when(kind == transforms.PIXEL, doubles(0, 100)).otherwise(doubles(0, 50))
    values = F.when(kind == transforms.PIXEL, doubles(0, 200)).when(kind == transforms.LOG, doubles(0, 2)).when(bad, doubles(10, 10)).otherwise(doubles(10, 60))
    parts = F.when(kind == transforms.FRACTION, doubles(F.when(bad, -v).otherwise(v), 50)).otherwise(doubles(v, 2 * v))
    true = (
        F.when(kind == transforms.SCALE, v * 60).when(kind == transforms.COMPLEMENT, 100 - v).when(kind == transforms.FRACTION, v / (v + 50) * 100).when(kind == transforms.LINEAR, 10 + v)
        .when(kind == transforms.LOG, F.pow(F.lit(10.0), v / 25)).when(kind == transforms.PIXEL, F.round((100 - v) / 100 * 200, 3)).otherwise(2 * v)
    )
    true_list = F.when(many, doubles(v * 3600, v * 120))
    off = lambda n: F.when(fault == n, 1.0).otherwise(0.0)
    shifted = lambda n: F.transform(true_list, lambda x: x + off(n))
    back, lost = F.when(kind == transforms.FRACTION, v / 50).otherwise(v), fault == 4
    receipt = F.struct(
        (fault != 5).alias("formal"), F.lit("f").alias("formula"), kind.alias("kind"),
        F.struct(v.alias("value"), F.lit(60.0).alias("scale"), F.when(bad, 3).otherwise(2).alias("component_count"), F.lit(100.0).alias("total"), parts.alias("components"), F.lit("a:b").alias("token"), positions.alias("positions"), values.alias("values"), F.array(F.struct(v.alias("value"), F.lit(3600.0).alias("scale")), F.struct((2 * v).alias("value"), F.lit(60.0).alias("scale"))).alias("steps")).alias("inputs"),
        F.struct(F.when(~many, true + off(1)).alias("value"), shifted(1).alias("values"), F.lit(1).alias("component")).alias("output"),
        F.struct(true.alias("computed"), F.when(~many, true + off(3)).alias("recorded"), shifted(3).alias("recorded_list"), F.lit(1e-6).alias("tolerance")).alias("forward"),
        F.struct(back.alias("computed"), F.when(~many & ~lost, back).alias("recorded"), F.when(many & ~lost, doubles(v, 2 * v)).alias("recorded_list"), F.lit("a:b").alias("computed_token"), F.when(~lost, F.lit("a:b")).alias("recorded_token"), F.lit(1e-6).alias("tolerance")).alias("reverse"),
    )
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = spread(table(spark, sf_dir, "lineitem").select(*keys, "l_quantity")).select(*keys, kind.alias("kind"), receipt.cast(transforms.RECEIPT).alias("receipt"), F.when(~many, true + off(2)).alias("actual"), shifted(2).alias("actual_list"))
    found = transforms.receipt_defects(F.col("receipt"), F.col("actual"), F.col("actual_list"))
    return rows.select(*keys, "kind", F.array_join(found, ",").alias("defects"))


HEADERS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ['kg/m3', 'vol.%', 'wt.%', '%', 'volume ratio', 'mass ratio', 'molar ratio', 'ratio', 'kg', 'mL', 'none', 'none'][1 + l_partkey % 12] AS unit,
  CASE WHEN l_linenumber % 2 = 0 THEN 'h' ELSE 'd' END AS time_unit
FROM lineitem
"""


@query(HEADERS)
def header_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers in twelve forms around the lines' numbers, and tokens that print a duration of the value beside them or of another."""
    forms = ("NaOH {} M (kg/m³)", "Content {} by volume, %", "Share {} wt. %", "Ash {} % of all", "Binder {} （vol.）", "Sand {} (mass)", "SiO2 {} molar  ratio", "w/b Ratio {}", "Cement {} ［㎏］", "Water {} ( mL )", "Size {} (um)", "Two {} (g) (kg)")
    n = F.col("l_suppkey").cast("string")
    header = F.array(*[F.format_string(f.replace("%", "%%").replace("{}", "%s"), n) for f in forms])[(F.col("l_partkey") % 12).cast("int")]
    token = F.format_string("%s h", (F.col("l_linenumber") + F.when(F.col("l_linenumber") % 2 == 0, 0).otherwise(1)).cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.header_unit(header, F.lit("none")).alias("unit"), text.time_unit(F.col("l_linenumber").cast("double"), F.lit("d"), token).alias("time_unit")
    )


QUANTITIES = """
WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT) AS n, l_partkey % 8 AS form FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE form WHEN 0 THEN n + 0.5 WHEN 1 THEN n WHEN 4 THEN n WHEN 5 THEN -n END AS DOUBLE) AS value,
  CASE form WHEN 0 THEN 'approximate' WHEN 1 THEN 'exact' WHEN 2 THEN 'range' WHEN 3 THEN CASE WHEN n % 2 = 0 THEN '<=' ELSE '≥' END WHEN 4 THEN 'plus_minus' WHEN 5 THEN 'exact' WHEN 6 THEN 'above_instrument_range' ELSE 'textual_quantity' END AS relation,
  CAST(CASE WHEN form = 2 THEN n END AS DOUBLE) AS lower, CAST(CASE WHEN form = 2 THEN n + 2 END AS DOUBLE) AS upper, CAST(CASE WHEN form = 3 THEN n END AS DOUBLE) AS bound, CAST(CASE WHEN form = 4 THEN 0.25 END AS DOUBLE) AS tolerance
FROM q
"""


@query(QUANTITIES)
def qualified_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines' quantities printed in eight forms, read back."""
    n = F.col("l_quantity").cast("int")
    even = n % 2 == 0
    joined = lambda *x: F.concat(*[c.cast("string") if hasattr(c, "cast") else F.lit(c) for c in x])
    forms = F.array(joined(F.when(even, "~").otherwise("about "), n, ".5"), joined(n, F.when(even, "").otherwise("e0")), joined(" ", n, F.when(even, "–").otherwise(" to "), n + 2, " "), joined(F.when(even, "<= ").otherwise("≥"), n), joined(n, " ± 0.25"), joined("−", n), F.when(even, "max").otherwise("MAX"), joined(n, " or so"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.quantity(forms[(F.col("l_partkey") % 8).cast("int")]).alias("q"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q.*")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(10 + (l_quantity - 0) / 50 * 90, 6) AS coordinate, round(power(10, l_quantity / 50 * 2), 4) AS log_coordinate, round(l_quantity, 6) AS position FROM lineitem")
def axis_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p0, v0, p1, v1 = (F.lit(float(x)) for x in (0, 10, 50, 100))
    p = F.col("l_quantity")
    value = transforms.axis_value(p, p0, v0, p1, v1)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(value, 6).alias("coordinate"), F.round(transforms.axis_value(p, p0, F.lit(1.0), p1, F.lit(100.0), log=True), 4).alias("log_coordinate"),
        F.round(transforms.axis_position(value, p0, v0, p1, v1), 6).alias("position"),
    )


@query("""
WITH fit AS (SELECT l_suppkey, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, count(*) AS n FROM lineitem GROUP BY l_suppkey)
SELECT l.l_suppkey, CAST(max(f.n) AS BIGINT) AS n, round(max(f.slope), 4) AS slope, round(max(f.intercept), 2) AS intercept, round(max(abs(l.l_extendedprice - f.slope * l.l_quantity - f.intercept)), 2) AS residual
FROM lineitem l JOIN fit f ON l.l_suppkey = f.l_suppkey WHERE f.n >= 3 GROUP BY l.l_suppkey
""")
def tick_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    fit = rows.groupBy("l_suppkey").agg(F.regr_slope("l_extendedprice", "l_quantity").alias("slope"), F.regr_intercept("l_extendedprice", "l_quantity").alias("intercept"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    off = F.abs(F.col("l_extendedprice") - F.col("slope") * F.col("l_quantity") - F.col("intercept"))
    got = rows.join(fit, "l_suppkey").groupBy("l_suppkey", "n", "slope", "intercept").agg(F.max(off).alias("residual"))
    return got.select("l_suppkey", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("residual", 2).alias("residual"))


@query(r"""
WITH f AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) || CASE WHEN l_discount < 0.03 THEN ' and ' WHEN l_discount < 0.06 THEN '; ' ELSE ' MPa, ' END || CASE WHEN l_tax < 0.04 THEN CAST(l_partkey AS VARCHAR) ELSE l_returnflag END || CASE WHEN l_shipdate < TIMESTAMP '1995-01-01' THEN ' respectively' ELSE ' h' END AS fact FROM lineitem)
SELECT l_orderkey, l_linenumber, fact, len(regexp_extract_all(fact, '[0-9]+')) > 1 AND regexp_matches(fact, ';|\band\b|\brespectively\b') AS multiple FROM f
""")
def multi_value_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = F.when(F.col("l_discount") < 0.03, " and ").when(F.col("l_discount") < 0.06, "; ").otherwise(" MPa, ")
    second = F.when(F.col("l_tax") < 0.04, F.col("l_partkey").cast("string")).otherwise(F.col("l_returnflag"))
    fact = F.concat(F.col("l_quantity").cast("long"), join, second, F.when(F.col("l_shipdate") < "1995-01-01", " respectively").otherwise(" h"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fact.alias("fact"))
    return rows.withColumn("multiple", text.multiple_values(F.col("fact")))


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'blocked' WHEN quality = 1 THEN 'formal' WHEN quality = 0 THEN 'candidate' ELSE 'unknown' END AS source_code FROM labels")
def vocab_source_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("toxic") == 1, "blocked").when(F.col("quality") == 1, "formal").when(F.col("quality") == 0, "candidate").otherwise("unknown")
    return table(spark, sf_dir, "labels").select("doc_id", code.alias("source_code"))


@query("""
WITH f AS (SELECT doc_id, trim(string_split(text, chr(10))[1]) AS h FROM documents)
SELECT doc_id, CASE WHEN length(h) <= 80 AND (regexp_matches(h, '^[0-9]+\\.(?:[0-9]+\\.?)*\\s+[A-Za-z]') OR lower(h) IN ('abstract', 'introduction', 'methods', 'results', 'conclusions', 'references')) THEN h END AS heading, length(h) <= 80 AS is_short FROM f
""")
def section_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.trim(F.split("text", "\n")[0])
    return table(spark, sf_dir, "documents").select("doc_id", text.section_heading(F.col("text")).alias("heading"), (F.length(first) <= 80).alias("is_short"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.missing') AS VARCHAR) AS missing FROM events")
def json_pointer_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", json_paths.read(F.col("props"), "/k", "bigint").alias("k"), json_paths.read(F.col("props"), "/missing").alias("missing"))


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ['duration', 'pressure', 'duration', 'temperature'][1 + l_linenumber % 4] AS name, ['h', 'kPa', 'd', '°C'][1 + l_linenumber % 4] AS unit, CAST(CASE WHEN l_partkey % 5 <> 0 THEN l_quantity END AS DOUBLE) AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ['s', 'Pa', 's', '°C'][1 + l_linenumber % 4] AS target_unit, round(v * [3600, 1000, 86400, 1][1 + l_linenumber % 4], 4) AS normalised, round(v, 4) AS reverse FROM s
""")
def stage_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.col("l_linenumber") % 4).cast("int")
    pick = lambda *x: F.array(*map(F.lit, x))[kind]
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(*keys, pick("duration", "pressure", "duration", "temperature").alias("name"), pick("h", "kPa", "d", "°C").alias("unit"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("double")).alias("v"))
    return units.normalised_stages(rows, "name", "v", "unit").select(*keys, "target_unit", F.round("normalised", 4).alias("normalised"), F.round("reverse", 4).alias("reverse"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN round((o_custkey % 80) + 10.0, 1) END AS value, CASE WHEN o_orderkey % 5 = 0 THEN 2.5 END AS error_scale, ['ESTIMATE', 'NOT_ON_BASELINE', 'OUTSIDE_PLOT', 'EXTRAPOLATED', 'INVALID_BOX'][1 + o_orderkey % 5] AS status FROM orders
""")
def bar_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bars on an axis of 200 pixels from 200 (value 0) upwards: sound ones and one for each defect."""
    case, high = F.col("o_orderkey") % 5, (F.col("o_custkey") % 80 + 10).cast("double")
    top = F.when(case == 2, -30.0).when(case == 3, 40.0).otherwise(200 - high)
    foot = F.when(case == 1, 190.0).when(case == 4, top).otherwise(201.0)
    ticks = F.when(case == 3, F.array(*map(F.lit, (200.0, 180.0, 160.0)))).otherwise(F.array(*map(F.lit, (200.0, 150.0, 100.0, 50.0, 0.0))))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", top.alias("top"), foot.alias("foot"), ticks.alias("ticks"), case.alias("case"))
    got = transforms.bar_measure(F.when(F.col("case") == 1, 170.0).otherwise(F.col("top")), F.col("foot"), F.lit(-1.0), F.lit(200.0), F.col("ticks"), F.lit(0.0), F.lit(200.0), F.lit(0.5))
    return rows.select("o_orderkey", got.alias("m")).select("o_orderkey", "m.*")
