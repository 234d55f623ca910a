"""Replay: candidates are rebuilt from their stored source, stage by stage, and held against a receipt of hashes.

A receipt has one hash for each item (a figure, a table) and stage, the source being the first. A hash is taken over the item's rows as canonical texts (names sorted,
nulls kept, numbers to nine digits after the point) and does not depend on their order: rows are hashed, dealt to PARTS parts by their hash, and the parts' hashes are hashed in
order, so no item has to be sorted as a whole. Replaying compares per item and tells the first stage that differs, so that a changed source is told from a changed rule or report.

Defined cases: repeated rows count as often as they come; a row with a null item belongs to the item null, which is compared like any other; an item that only the receipt or only the replay
has is MISSING or NEW at its first stage; an empty source has an empty receipt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.plans.storage import written

PARTS = 64
SOURCE = "source"
Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def canonical_row(df: DataFrame) -> Column:
    """A row's text; fractions are written with nine digits, minus nothing is nothing."""
    cells = []
    for name in sorted(df.columns):
        kind, c = df.schema[name].dataType.simpleString(), F.col("`" + name.replace("`", "``") + "`")
        if kind in ("double", "float"):
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), c.cast("string")).otherwise(F.format_string("%.9f", F.round(c.cast("double"), 9) + F.lit(0.0)))
        cells.append(c.alias(name))
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def item_hashes(df: DataFrame, item: str, stage: str) -> DataFrame:
    """(item, stage, n, sha256) of the rows of each item."""
    rows = df.select(F.col(item).alias("item"), F.sha2(canonical_row(df).cast("binary"), 256).alias("h"))
    part = F.pmod(F.conv(F.substr("h", F.lit(1), F.lit(4)), 16, 10).cast("int"), F.lit(PARTS))
    counted = rows.groupBy("item", part.alias("part"), "h").agg(F.count(F.lit(1)).alias("n"))  # equal rows are one entry with a number
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("h", "n"))), lambda e: F.concat_ws("x", e["h"], e["n"].cast("string"))), ",")
    parts = counted.groupBy("item", "part").agg(F.sha2(told.cast("binary"), 256).alias("h"), F.sum("n").alias("n"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "h"))), lambda e: e["h"]), ",")
    return parts.groupBy("item").agg(F.sum("n").alias("n"), F.sha2(whole.cast("binary"), 256).alias("sha256")).select("item", F.lit(stage).alias("stage"), "n", "sha256")


def receipt(source: DataFrame, stages: list[Stage], item: str) -> DataFrame:
    """(item, stage, place, n, sha256) of the source and of what each stage makes of the stage before; the stages run while the frame is built, each once."""
    now, out = source, item_hashes(source, item, SOURCE).withColumn("place", F.lit(0))
    for place, (name, rule) in enumerate(stages, 1):
        now = written(rule(now))
        out = out.unionByName(item_hashes(now, item, name).withColumn("place", F.lit(place)))
    return written(out)


def verify(source: DataFrame, stages: list[Stage], item: str, claimed: DataFrame) -> DataFrame:
    """(item, verdict, stage, defect): PASS, or REJECT with the first stage at which the replay differs: CHANGED, MISSING (only claimed) or NEW (only replayed)."""
    now = receipt(source, stages, item).select("item", "stage", F.col("sha256").alias("now"))
    order = F.create_map(*[F.lit(x) for place, (name, _) in enumerate([(SOURCE, None), *stages]) for x in (name, place)])
    was = claimed.select(F.col("item").alias("_i"), F.col("stage").alias("_s"), F.col("sha256").alias("was"))
    met = now.join(was, F.col("item").eqNullSafe(F.col("_i")) & (F.col("stage") == F.col("_s")), "full").withColumns({"item": F.coalesce("item", "_i"), "stage": F.coalesce("stage", "_s")})
    defect = F.when(F.col("now").isNull(), "MISSING").when(F.col("was").isNull(), "NEW").when(F.col("now") != F.col("was"), "CHANGED")
    told = met.select("item", F.struct(order[F.col("stage")].alias("place"), "stage", defect.alias("defect")).alias("d")).groupBy("item").agg(F.min(F.when(F.col("d.defect").isNotNull(), F.col("d"))).alias("d"))
    return told.select("item", F.when(F.col("d").isNull(), "PASS").otherwise("REJECT").alias("verdict"), F.col("d.stage").alias("stage"), F.col("d.defect").alias("defect"))
