"""Shares of a whole, their gates and the intervals that printed digits allow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shares(rows: DataFrame, group: str, value: str) -> DataFrame:
    """`rows` with total and percent of the group's total; null where the total is not positive."""
    whole = F.sum(value).over(Window.partitionBy(group))
    return rows.withColumn("total", whole).withColumn("percent", F.when(F.col("total") > 0, F.col(value) * 100.0 / F.col("total")))


def normalisation(rows: DataFrame, group: str, value: str, limit: float = 100.000001) -> DataFrame:
    """`rows` with original_total (8 digits) and, where all values are known and the total exceeds the limit, the normalised value."""
    whole = Window.partitionBy(group)
    known = F.count(value).over(whole) == F.count(F.lit(1)).over(whole)
    out = rows.withColumn("original_total", F.round(F.sum(value).over(whole), 8))
    return out.withColumn("normalised", F.when(known & (F.col("original_total") > limit), F.col(value) / F.col("original_total") * 100))


def total_gate(rows: DataFrame, group: str, value: str, limit: float) -> DataFrame:
    """(group, total, verdict): DEFECT where the total exceeds the limit."""
    got = rows.groupBy(group).agg(F.sum(value).alias("total"))
    return got.withColumn("verdict", F.when(F.col("total") > limit, "DEFECT").otherwise("PASS"))


def printed_half_step(text: Column) -> Column:
    """Half a unit of the last printed digit."""
    digits = F.length(F.regexp_extract(text, r"\.([0-9]*)", 1))
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    return F.pow(F.lit(10.0), (exponent - digits).cast("double")) / 2


def bounds(rows: DataFrame, group: str, value: str, half_step: Column) -> DataFrame:
    """`rows` with percent, lower and upper: each value's rounding interval against those of the others.

    Sums over the group less the row's own part, so a group is read once and never joined with itself.
    """
    low, high = F.greatest(F.col(value) - half_step, F.lit(0.0)), F.col(value) + half_step
    whole = Window.partitionBy(group)
    out = rows.withColumns({"_lo": low, "_hi": high})
    out = out.withColumns({"_slo": F.sum("_lo").over(whole), "_shi": F.sum("_hi").over(whole), "_t": F.sum(value).over(whole)})
    other_low, other_high = F.col("_slo") - F.col("_lo"), F.col("_shi") - F.col("_hi")
    out = out.withColumns({
        "percent": F.when(F.col("_t") > 0, 100 * F.col(value) / F.col("_t")),
        "lower": F.coalesce(F.try_divide(100 * F.col("_lo"), F.col("_lo") + other_high), F.lit(100.0)),
        "upper": F.try_divide(100 * F.col("_hi"), F.col("_hi") + other_low),
    })
    return out.drop("_lo", "_hi", "_slo", "_shi", "_t")


def masses(parts: DataFrame, recipe: str, share: str, density: Column, total: Column) -> DataFrame:
    """`parts` with mass and volume of each component: its share of the recipe's total mass, and that by its density; null where a share, the total or a positive density is unknown."""
    mass = F.when(F.col(share).between(0, 100) & (total > 0), F.col(share) / 100.0 * total)
    out = parts.withColumn("mass", mass).withColumn("volume", F.when(density > 0, F.col("mass") / density))
    whole = Window.partitionBy(recipe)
    return out.withColumn("complete", F.coalesce(F.abs(F.sum(share).over(whole) - 100) <= 0.11, F.lit(False)) & (F.count_if(F.col("mass").isNull()).over(whole) == 0))
