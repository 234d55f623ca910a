"""Marker-line texts: TAG|id|name=value|... lines of a paper as relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.text import doi

#: Tags of the format.
TAGS = ("TITLE", "DOI", "YEAR", "MATERIAL", "XRF", "PSD", "MIX", "CURING", "PERFORMANCE", "AMBIGUITY")


def lines(papers: DataFrame, paper: str = "paper", text: str = "text") -> DataFrame:
    """(paper, line_no, tag, item, fields): one row per marker line; other lines are left out."""
    rows = papers.select(F.col(paper).alias("paper"), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\r?\n")).alias("line_no", "line"))
    parts = F.split("line", r"\|")
    pairs = F.filter(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: F.contains(p, F.lit("=")))
    keyed = F.transform(pairs, lambda p: F.struct(F.trim(F.split_part(p, F.lit("="), F.lit(1))).alias("key"), F.trim(F.substr(p, F.instr(p, "=") + 1)).alias("value")))
    # Of a repeated name the last value stays.
    last = F.filter(keyed, lambda e, i: ~F.exists(F.slice(keyed, i + 2, F.size(keyed)), lambda o: o.key == e.key))
    out = rows.select("paper", "line_no", parts[0].alias("tag"), F.get(parts, 1).alias("item"), F.map_from_entries(last).alias("fields"))
    return out.where(F.col("tag").isin(*TAGS))


def field(name: str) -> Column:
    return F.nullif(F.col("fields")[name], F.lit(""))


def number(name: str) -> Column:
    return F.expr(f"try_cast(nullif(fields['{name}'], '') AS double)")


def papers(marked: DataFrame) -> DataFrame:
    """(paper, title, doi, year): the first line of each kind."""
    first = lambda tag: F.min_by("item", F.when(F.col("tag") == tag, F.col("line_no")))
    return marked.groupBy("paper").agg(first("TITLE").alias("title"), doi(first("DOI")).alias("doi"), first("YEAR").try_cast("int").alias("year"))


def materials(marked: DataFrame) -> DataFrame:
    """(paper, mat_key, material_type, specific_surface_m2_kg): cm2/g becomes m2/kg; other units give null."""
    unit = F.regexp_replace(F.replace(F.lower(field("specific_surface_unit")), F.lit("²"), F.lit("2")), r"[\s^]", "")
    factor = F.when(unit == "m2/kg", 1.0).when(unit == "cm2/g", 0.1)
    rows = marked.where("tag = 'MATERIAL'")
    return rows.select("paper", F.concat(F.lit("mat-"), "item").alias("mat_key"), field("material_type").alias("material_type"), (number("specific_surface") * factor).alias("specific_surface_m2_kg"), number("D50_um").alias("d50_um"))


def oxides(marked: DataFrame) -> DataFrame:
    """(paper, mat_key, component, value): one row per oxide of an XRF line."""
    rows = marked.where("tag = 'XRF'").select("paper", F.concat(F.lit("mat-"), "item").alias("mat_key"), F.explode("fields").alias("component", "value"))
    return rows.withColumn("value", F.col("value").try_cast("double"))


def mixes(marked: DataFrame) -> DataFrame:
    """(paper, mix_key, specimen_type, mat_keys, masses_g)."""
    mass = F.transform(F.filter(F.split(F.coalesce(field("masses_g"), F.lit("")), ","), lambda p: F.contains(p, F.lit(":"))), lambda p: F.struct(F.trim(F.split_part(p, F.lit(":"), F.lit(1))).alias("k"), F.split_part(p, F.lit(":"), F.lit(2)).try_cast("double").alias("v")))
    refs = F.transform(F.filter(F.split(F.coalesce(field("mat_refs"), F.lit("")), ","), lambda p: F.trim(p) != ""), lambda p: F.concat(F.lit("mat-"), F.trim(p)))
    return marked.where("tag = 'MIX'").select("paper", F.concat(F.lit("mix-"), "item").alias("mix_key"), field("specimen_type").alias("specimen_type"), refs.alias("mat_keys"), F.map_from_entries(mass).alias("masses_g"))


def curing(marked: DataFrame) -> DataFrame:
    rows = marked.where("tag = 'CURING'")
    return rows.select("paper", F.concat(F.lit("mix-"), "item").alias("mix_key"), "line_no", field("method").alias("method"), number("temperature_C").alias("temperature_c"), number("humidity_percent").alias("humidity_percent"), (number("duration_d") * 86400).alias("duration_seconds"))


def performance(marked: DataFrame) -> DataFrame:
    rows = marked.where("tag = 'PERFORMANCE'")
    return rows.select("paper", F.concat(F.lit("mix-"), "item").alias("mix_key"), "line_no", field("name").alias("name"), number("value").alias("value"), field("unit").alias("unit"), (number("age_d") * 86400).alias("age_seconds"), field("specimen").alias("specimen"))


def ambiguities(marked: DataFrame) -> DataFrame:
    """(paper, mix_key, field, reason): fields that stay null until someone decides."""
    return marked.where("tag = 'AMBIGUITY'").select("paper", F.concat(F.lit("mix-"), "item").alias("mix_key"), field("field").alias("field"), field("reason").alias("reason"))
