"""Total orders, limits, diversified and balanced selections."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.plans.storage import cut, written


def ranked(rows: DataFrame, order: list[Column | str], k: int | None = None, group: list[str] | None = None, name: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank. Without a group the limit comes first, so that only k rows meet in one task."""
    if not group:
        rows = rows.orderBy(*order).limit(k) if k is not None else rows
    out = rows.withColumn(name, F.row_number().over(Window.partitionBy(*(group or [])).orderBy(*order)))
    return out.where(F.col(name) <= k) if k is not None else out


def page(rows: DataFrame, order: list[Column | str], offset: int, size: int) -> DataFrame:
    """Rows offset+1 to offset+size of a total order."""
    return rows.orderBy(*order).limit(offset + size).orderBy(*order).offset(offset)


def spread_hosts(rows: DataFrame, host: str, order: list[str], k: int) -> DataFrame:
    """The greedy choice of the least used host, as two ranks: a row's place within its host, then the order."""
    placed = rows.withColumn("turn", F.row_number().over(Window.partitionBy(host).orderBy(*order)))
    return ranked(placed, ["turn", *order], k, name="pick")


def spread_strata(rows: DataFrame, host: str, strata: str, order: list[str], k: int, one: bool = False, short: str = "keep") -> DataFrame:
    """The greedy choice by least used host, then least used stratum, then order: sequential by definition.

    With `one`, a row counts for the least used of its strata only (the first by name), which is told as selected_stratum.
    With short="error" a pool of fewer than k rows is an error when it is read. What can never be picked stays out of the one
    task: of each (host, strata) all but the k first rows; and where there are k hosts or more, so that none is taken twice, all
    but the first row of each (host, strata) and the k first hosts of each strata.
    """
    able = rows.withColumn("_r", F.row_number().over(Window.partitionBy(host, strata).orderBy(*order))).where(F.col("_r") <= k)
    if able.select(host).distinct().limit(k).count() == k:
        able = able.where("_r = 1").withColumn("_r", F.row_number().over(Window.partitionBy(strata).orderBy(*order))).where(F.col("_r") <= k)
    able = able.drop("_r")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf.sort_values(order, kind="stable").to_dict("records")
        queues: dict[tuple, list[dict]] = {}
        for place, row in enumerate(left):
            queues.setdefault((row[host], tuple(row[strata])), []).append(row | {"_place": place})
        hosts: dict[object, int] = {}
        seen: dict[object, int] = {}
        out = []
        least = lambda q: min(((seen.get(s, 0), s) for s in q[1]), default=(0, None))
        while queues and len(out) < k:
            chosen = min(queues, key=lambda q: (hosts.get(q[0], 0), least(q)[0], queues[q][0]["_place"]))
            row = queues[chosen].pop(0)
            if not queues[chosen]:
                del queues[chosen]
            hosts[chosen[0]] = hosts.get(chosen[0], 0) + 1
            stratum = least(chosen)[1]
            for s in [stratum] if one else chosen[1]:
                seen[s] = seen.get(s, 0) + 1
            row.pop("_place")
            out.append(row | {"selected_stratum": stratum, "pick": len(out) + 1})
        return pd.DataFrame(out, columns=[*pdf.columns, *extra])

    extra = ["selected_stratum", "pick"] if one else ["pick"]
    picked = able.groupBy().applyInPandas(run, f"{rows._jdf.schema().toDDL()}, " + ("selected_stratum string, " if one else "") + "pick long")
    if short == "error":
        lacking = F.max("pick").over(Window.partitionBy()) < k  # k rows at most
        picked = picked.withColumn("pick", F.when(lacking, F.raise_error(F.lit(f"INSUFFICIENT_POOL_COVERAGE: fewer than {k} rows")).cast("long")).otherwise(F.col("pick")))
    return picked


def recommended(ranked_rows: DataFrame, rank: str, is_open: Column) -> DataFrame:
    """`ranked_rows` with recommended: the first open one, else the first."""
    order = Window.partitionBy().orderBy(~F.coalesce(is_open, F.lit(False)), rank)  # rows of one limit
    return ranked_rows.withColumn("recommended", F.row_number().over(order) == 1)


def labelled_first(candidates: DataFrame, group: str, label: Column, key: str) -> DataFrame:
    """(group, key): the candidate whose label is the asked one, else the first key."""
    order = Window.partitionBy(group).orderBy(~F.coalesce(label, F.lit(False)), key)
    return candidates.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def balanced_shards(items: DataFrame, item: str, weight: str, shards: int, group: str | None = None) -> DataFrame:
    """(item, shard): heaviest first to the least loaded shard, ties to the smaller one; sequential within a group.

    The rule has no parallel form, so a group (all items where none is given) is one task: for plans of work, not for data.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        loads = [(0, s) for s in range(min(shards, max(1, len(pdf))))]
        out = []
        for row in pdf.sort_values([weight, item], ascending=[False, True], kind="stable").itertuples(index=False):
            load, shard = heapq.heappop(loads)
            out.append((getattr(row, item), shard))
            heapq.heappush(loads, (load + int(getattr(row, weight)), shard))
        return pd.DataFrame(out, columns=[item, "shard"])

    by = [group] if group else []
    return items.select(*by, item, weight).groupBy(*by).applyInPandas(run, f"{item} {items.schema[item].dataType.simpleString()}, shard long")


def even_shards(items: DataFrame, item: str, shards: int) -> DataFrame:
    """(item, shard) of equal size in item order, the remainder in the last shard.

    The place of an item is its place in its range partition plus the sizes of the ranges before, so no task sorts all items.
    """
    n = items.count()
    size = max(1, n // shards)
    ranges = cut(items.select(item).repartitionByRange(item).withColumn("_p", F.spark_partition_id()))
    sizes = ranges.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).collect()  # one row a partition
    before, start = {}, 0
    for row in sorted(sizes, key=lambda r: r["_p"]):
        before[row["_p"]], start = start, start + row["_n"]
    offset = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("_p")] if before else F.lit(0)
    place = offset + F.row_number().over(Window.partitionBy("_p").orderBy(item)) - 1
    return ranges.select(item, F.least(F.floor(place / size), F.lit(shards - 1)).cast("long").alias("shard"))


def pairs_of_two(items: DataFrame, group: str, order: str) -> DataFrame:
    """`items` with a pair number: the first and second, the third and fourth and so on of each group."""
    return items.withColumn("pair", F.ceil(F.row_number().over(Window.partitionBy(group).orderBy(order)) / 2).cast("long"))


def page_span(headings: DataFrame, group: str, page_: str, title: str, first: str, last: str, most: int = 5) -> DataFrame:
    """(group, page): pages from the first heading of one kind to the next of another, where the span is short enough."""
    start = headings.where(F.lower(title) == first).groupBy(group).agg(F.min(page_).alias("_a"))
    ends = headings.where(F.lower(title) == last).join(start, group).where(F.col(page_) >= F.col("_a")).groupBy(group).agg(F.min(page_).alias("_b"))
    span = start.join(ends, group).where(F.col("_b") - F.col("_a") < most)
    return span.select(group, F.explode(F.sequence("_a", "_b")).alias(page_))


def numbered(rows: DataFrame, place: str, *order: Column) -> DataFrame:
    """`rows` with their place (from 1) in one order of all: dealt to ranges of the order, counted by range, and numbered within each.

    The dealt rows are written while the frame is built, as the ranges must stay. Rows that the order holds equal are of one range, so it should tell rows apart.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # one row a range
    within = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return within.join(F.broadcast(starts), "_p").withColumn(place, F.col("_start") + F.col("_r")).drop("_p", "_start", "_r")
