"""Unit conversion as a broadcast dimension: (scope, name, unit) to (target, factor)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What each quantity is stated in, and the factors of the units it is printed in.
STRESS = {"MPa": ("MPa", 1.0), "GPa": ("MPa", 1000.0), "kPa": ("MPa", 0.001)}
DENSITY = {"kg/m3": ("kg/m3", 1.0), "g/cm3": ("kg/m3", 1000.0)}
PERCENT = {"%": ("percent", 1.0), "percent": ("percent", 1.0)}
SECONDS = {"s": ("s", 1.0), "min": ("s", 60.0), "h": ("s", 3600.0), "hours": ("s", 3600.0), "d": ("s", 86400.0), "days": ("s", 86400.0)}
LENGTH = {"um": ("um", 1.0), "µm": ("um", 1.0), "μm": ("um", 1.0), "mm": ("um", 1000.0), "nm": ("um", 0.001)}
PHYSICAL = {
    "specific_surface_m2_kg": {"m2/kg": ("m2/kg", 1.0), "m2/g": ("m2/kg", 1000.0), "cm2/g": ("m2/kg", 0.1)},
    "true_density_kg_m3": DENSITY,
    "apparent_density_kg_m3": DENSITY,
    "bulk_density_kg_m3": DENSITY,
    "total_porosity_percent": PERCENT,
    "open_porosity_percent": PERCENT,
    "closed_porosity_percent": PERCENT,
    "d10_um": LENGTH,
    "d50_um": LENGTH,
    "d90_um": LENGTH,
    "duration_seconds": SECONDS,
    "age_seconds": SECONDS,
}
PERFORMANCE = {
    **{n: STRESS for n in ("compressive_strength", "flexural_strength", "splitting_tensile_strength", "tensile_strength", "elastic_modulus", "dynamic_elastic_modulus")},
    "flow_diameter": {"mm": ("mm", 1.0)},
    "slump": {"mm": ("mm", 1.0), "cm": ("mm", 10.0)},
    "initial_setting_time": {"min": ("s", 60.0), "s": ("s", 1.0)},
    "final_setting_time": {"min": ("s", 60.0), "s": ("s", 1.0)},
    "bulk_density": DENSITY,
    **{n: {"%": ("%", 1.0)} for n in ("bleeding_rate", "water_absorption", "open_porosity", "total_porosity")},
}


def dimension(spark: SparkSession) -> DataFrame:
    rows = [(kind, name, unit, target, factor) for kind, names in (("field", PHYSICAL), ("performance", PERFORMANCE)) for name, units in names.items() for unit, (target, factor) in units.items()]
    return spark.createDataFrame(rows, "kind string, name string, unit string, target string, factor double")


def plain_unit(unit: Column) -> Column:
    return F.translate(unit, "²³", "23")


def convert(values: DataFrame, kind: str = "kind", name: str = "name", unit: str = "unit", value: str = "value") -> DataFrame:
    """`values` with target_unit, converted and reverse (converted back); unknown units pass unchanged. The dimension is a fixed small table."""
    dim = dimension(values.sparkSession).select(F.col("kind").alias("_k"), F.col("name").alias("_n"), F.col("unit").alias("_u"), "target", "factor")
    met = values.join(F.broadcast(dim), (F.col(kind) == F.col("_k")) & (F.col(name) == F.col("_n")) & (plain_unit(F.col(unit)) == F.col("_u")), "left")
    factor = F.coalesce("factor", F.lit(1.0))
    return met.withColumns({"target_unit": F.coalesce("target", plain_unit(F.col(unit))), "converted": F.col(value) * factor, "reverse": F.col(value) * factor / factor}).drop("_k", "_n", "_u", "target", "factor")


def ratio(text: Column) -> Column:
    """Value of a printed ratio a/b or a|b; null for other texts and for a zero below."""
    pattern = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*[/|]\s*([0-9]+(?:\.[0-9]+)?)\s*$"
    return F.when(text.rlike(pattern), F.try_divide(F.regexp_extract(text, pattern, 1).cast("double"), F.regexp_extract(text, pattern, 2).cast("double")))


#: Units of a curing stage and what they are in s or Pa.
STAGE_UNITS = {"duration": {"s": 1.0, "h": 3600.0, "d": 86400.0, "min": 60.0}, "pressure": {"Pa": 1.0, "kPa": 1000.0, "MPa": 1000000.0}}
STAGE_TARGETS = {"duration": "s", "pressure": "Pa"}


def normalised_stages(stages: DataFrame, name: str, value: str, unit: str, uncertainty: str | None = None) -> DataFrame:
    """`stages` with target_unit, normalised, scale, reverse and (if given) the normalised uncertainty; other names and units keep theirs, and a product that is not finite is an error."""
    factors = F.create_map(*[x for n, units in STAGE_UNITS.items() for u, f in units.items() for x in (F.lit(f"{n}|{u}"), F.lit(f))])
    targets = F.create_map(*[F.lit(x) for kv in STAGE_TARGETS.items() for x in kv])
    scale = F.coalesce(factors[F.concat_ws("|", F.col(name), F.col(unit))], F.lit(1.0))
    made = F.col(value) * scale
    finite = F.when(made.isNull() | (~F.isnan(made) & (F.abs(made) < float("inf"))), made).otherwise(F.raise_error(F.lit("a normalised stage value overflows")).cast("double"))
    out = stages.withColumns({"target_unit": F.coalesce(targets[F.col(name)], F.col(unit)), "normalised": finite, "scale": F.when(made.isNotNull(), scale)}).withColumn("reverse", F.col("normalised") / F.col("scale"))
    return out.withColumn(f"{uncertainty}_normalised", F.col(uncertainty) * scale) if uncertainty else out
