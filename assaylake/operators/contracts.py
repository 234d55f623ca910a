"""Joins and sets that must hold: every operator tells what breaks instead of repairing it silently."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_reason(*cases: tuple[Column, str]) -> Column:
    """The reason of the first condition that holds; null if none does."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in cases])


def reasons(*cases: tuple[Column, str]) -> Column:
    """All reasons that hold, in order."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in cases]), lambda x: x.isNotNull())


def small(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """`rows`, marked for a broadcast where it was counted to be small enough."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def unique_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` with key_count and is_unique of their key."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return rows.withColumn("key_count", n).withColumn("is_unique", F.col("key_count") == 1)


def exactly_one(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """`left` with the row of `right` that alone has its key, and status EXTRACTED, MISSING or AMBIGUOUS.

    The right side is reduced to one row a key before the join, so a left row never multiplies.
    """
    one = right.groupBy(F.col(right_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*right.columns)).alias("_row"))
    met = left.join(one, F.col(left_key) == F.col("_key"), "left")
    status = F.when(F.col("_n").isNull(), "MISSING").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("EXTRACTED")
    values = [F.when(F.col("_n") == 1, F.col("_row")[c]).alias(c) for c in right.columns]
    return met.select(*left.columns, *values, status.alias("status"))


def foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, edge: str) -> DataFrame:
    """One row: edge, rows of `child` and how many of them have no parent."""
    known = parent.select(F.col(parent_key).alias("_p")).distinct().withColumn("_known", F.lit(True))
    met = child.join(known, F.col(child_key) == F.col("_p"), "left")
    return met.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_known").isNull()).alias("n_orphans")).select(F.lit(edge).alias("edge"), "n_rows", "n_orphans")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of only one side, with the side."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").where("_l IS NULL OR _r IS NULL").select(key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def partition_gate(universe: DataFrame, parts: DataFrame, key: str, part: str) -> DataFrame:
    """Whether the parts are disjoint and cover the universe: one row of counts and a verdict."""
    held = parts.groupBy(key).agg(F.count_distinct(part).alias("_parts"))
    all_ = universe.select(key).distinct().join(held, key, "full").withColumn("_in", F.lit(1))
    base = universe.select(F.col(key).alias("_u")).distinct().withColumn("_known", F.lit(True))
    met = all_.join(base, F.col(key) == F.col("_u"), "left")
    out = met.agg(
        F.count_if(F.col("_parts").isNull()).alias("n_missing"), F.count_if(F.coalesce(F.col("_parts"), F.lit(0)) > 1).alias("n_overlapping"), F.count_if(F.col("_known").isNull()).alias("n_foreign"), F.count(F.lit(1)).alias("n_keys")
    )
    return out.withColumn("verdict", F.when((F.col("n_missing") + F.col("n_overlapping") + F.col("n_foreign")) == 0, "PASS").otherwise("REJECT"))


def disjoint_pools(pools: DataFrame, pool: str, key: str) -> DataFrame:
    """Per pair of pools that share keys: how many. Empty for disjoint pools; groups by key first, so no pair of all rows is made."""
    rows = pools.select(pool, key).distinct()
    a, b = rows.select(F.col(pool).alias("pool_a"), key), rows.select(F.col(pool).alias("pool_b"), key)
    return a.join(b, key).where("pool_a < pool_b").groupBy("pool_a", "pool_b").agg(F.count(F.lit(1)).alias("n_shared"))
