"""Views for review: matrices, paths, observation lists and routed facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def matrix(facts: DataFrame, record: str, label: str, value: str, labels: list[str]) -> DataFrame:
    """One row per record and one column per given label with its values in order, joined by `; `."""
    cells = [F.array_join(F.array_sort(F.collect_list(F.when(F.col(label) == name, F.col(value).cast("string")))), "; ").alias(name) for name in labels]
    return facts.groupBy(record).agg(*cells)


def distinct_observations(rows: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """The first row of each identity in order, with how often it came."""
    w = Window.partitionBy(*identity)
    out = rows.withColumns({"_r": F.row_number().over(w.orderBy(*order)), "n_seen": F.count(F.lit(1)).over(w)})
    return out.where("_r = 1").drop("_r")


def related_unique(rows: DataFrame, others: DataFrame, key: str, value: str) -> DataFrame:
    """`rows` with the value of the only other row of their key; null for none or several."""
    one = others.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_v"))
    return rows.join(one, key, "left").select(*rows.columns, F.when(F.col("_n") == 1, F.col("_v")).alias(value))


def path_text(points: DataFrame, curve: str, order: list[str], x: str, y: str, gap: str) -> DataFrame:
    """(curve, path): M x,y at the start and after gaps, L x,y else. A path is one text by definition."""
    first = F.row_number().over(Window.partitionBy(curve).orderBy(*order)) == 1
    step = F.concat(F.when(first | F.col(gap), "M").otherwise("L"), F.col(x).cast("string"), F.lit(","), F.col(y).cast("string"))
    steps = points.withColumn("_s", step)
    return steps.groupBy(curve).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_s"))), lambda p: p["_s"]), " ").alias("path"))


def route_facts(facts: DataFrame, kind: str, owner_kind: str, mixes: tuple[str, ...] = ("recipe", "performance"), known: tuple[str, ...] = ("spectral_assignment", "field", "xrf", "qxrd", "test_method", "recipe", "performance")) -> DataFrame:
    """`facts` with destination: the table of its kind; extensions for recipe or performance facts of other owners than mixes; else reported_observations."""
    where = F.when(F.col(kind).isin(*mixes) & (F.col(owner_kind) != "mix"), "extensions").when(F.col(kind).isin(*known), F.col(kind)).otherwise("reported_observations")
    return facts.withColumn("destination", where)


def numbered(facts: DataFrame, record: str, module: str, order: list[str]) -> DataFrame:
    """`facts` with their index, from 0, within record and module."""
    return facts.withColumn("index", F.row_number().over(Window.partitionBy(record, module).orderBy(*order)) - 1)


def reading_scope(blocks: DataFrame, scope: str, order: str, start, end) -> DataFrame:
    """Blocks between a start and the next end: the latest switch before or at a block decides, as a running last value."""
    switch = F.when(start, True).when(end, False)
    on = F.last(switch, ignorenulls=True).over(Window.partitionBy(scope).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return blocks.withColumn("_on", on).where("_on").drop("_on")


def specimen_variants(mixes: DataFrame, specimens: DataFrame, mix: str, specimen: str) -> DataFrame:
    """One empty record per mix and declared specimen type, with a key from both; specimens is a table of the declared types of each mix."""
    met = mixes.join(specimens, mix)
    return met.withColumn("variant_key", F.substr(F.sha2(F.concat_ws("|", F.col(mix).cast("string"), F.col(specimen)).cast("binary"), 256), F.lit(1), F.lit(24)))
