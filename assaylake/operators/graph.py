"""Connected components of an edge table by alternating large and small stars.

Every round rewires each node's neighbours to the smallest node it knows; edges never outnumber the
input. Rounds go on until the edge set stays as it is, so the result is exact; each round ends in a
checkpoint in the shared folder. Per-node minima are pre-aggregated before the shuffle and cut off, so
that a star's centre meets a plain join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.plans.storage import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("h")).first()
    return row["n"], int(row["h"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")))
    rewired = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rewired.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the smallest node it reaches."""
    now = cut(edges.where(f"{src} IS NOT NULL AND {dst} IS NOT NULL AND {src} != {dst}").select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).distinct())
    state = _state(now)
    while state[0]:
        now = cut(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
