"""Rule scores, arm metrics, verdicts and gates."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import doi, fold
from assaylake.operators.contracts import reasons

#: Criteria of a literature candidate, their points and the words that meet them.
WORD_RULES = (
    ("QXRD/Rietveld/amorphous", 30, r"\bqxrd\b|rietveld|quantitative x[- ]ray|amorphous"),
    ("MIX and macroscopic performance", 20, r"mix proportion|mixture proportion|compressive strength|flexural strength|mortar|paste"),
    ("PSD", 15, r"particle size|\bpsd\b|d10|d50|d90"),
    ("XRF", 15, r"\bxrf\b|x[- ]ray fluorescence|chemical composition"),
    ("Other characterization", 8, r"ft[- ]?ir|nmr|sem|eds|tga|calorim|xrd"),
)
IDENTITY_POINTS, ACCESS_POINTS, RECENT_YEAR = 7, 5, 2018


def explanation(rules: list[tuple[str, int, Column]]) -> Column:
    """array<struct(criterion, points, matched)>; unknown counts as not matched."""
    return F.array(*[F.struct(F.lit(n).alias("criterion"), F.when(F.coalesce(m, F.lit(False)), p).otherwise(0).alias("points"), F.coalesce(m, F.lit(False)).alias("matched")) for n, p, m in rules])


def total(explained: Column, without: str | None = None) -> Column:
    """Sum of points, of all criteria or all but one."""
    kept = explained if without is None else F.filter(explained, lambda x: x.criterion != without)
    return F.aggregate(kept, F.lit(0), lambda a, x: a + x.points)


def literature_rules(text: Column, doi_text: Column, sources: Column, link: Column, year: Column) -> list[tuple[str, int, Column]]:
    words = fold(text)
    return [
        *((n, p, words.rlike(pattern)) for n, p, pattern in WORD_RULES),
        ("Trusted identity", IDENTITY_POINTS, doi(doi_text).isNotNull() & (F.size(sources) > 0)),
        ("Accessible/recent", ACCESS_POINTS, (F.coalesce(link, F.lit("")) != "") | (F.coalesce(year, F.lit(0)) >= RECENT_YEAR)),
    ]


#: Items that are hashed together, see `order_hash`.
CHUNK = 4096


def order_hash(rows: DataFrame, keys: list[str], order: str, item: str) -> DataFrame:
    """(keys, order_sha256, n): a hash of the items of each group in their order.

    The items are cut into runs of CHUNK; the hash is that of the runs' hashes, so that no row holds a whole group. A group
    of one run has the hash of its items. Places in a large group are those of an ordered scan.
    """
    by = lambda *c: [F.col(k) for k in (*keys, *c)]
    placed = rows.withColumn("_run", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(order, item)) - 1) / CHUNK))
    joined = lambda items: F.array_join(F.transform(F.array_sort(items), lambda x: x["v"]), "\n")
    runs = placed.groupBy(*by("_run")).agg(joined(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i"), F.col(item).cast("string").alias("v")))).alias("_t"), F.count(F.lit(1)).alias("_n"))
    hashed = runs.select(*by("_run"), F.sha2(F.col("_t").cast("binary"), 256).alias("_h"), "_n")
    got = hashed.groupBy(*by()).agg(joined(F.collect_list(F.struct(F.col("_run").alias("o"), F.col("_h").alias("v")))).alias("_t"), F.max(F.when(F.col("_run") == 0, F.col("_h"))).alias("_only"), F.count(F.lit(1)).alias("_runs"), F.sum("_n").alias("n"))
    return got.select(*keys, F.when(F.col("_runs") == 1, F.col("_only")).otherwise(F.sha2(F.col("_t").cast("binary"), 256)).alias("order_sha256"), "n")


def arm_metrics(rows: DataFrame, arm: str, score: str, host: str, good: Column, strata: str | None = None, order: str | None = None, item: str | None = None) -> DataFrame:
    """(arm, n, mean_score, n_hosts, n_good), with n_strata if `strata` names an array and order_sha256 if an order is given."""
    out = rows.groupBy(arm).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.count_distinct(host).alias("n_hosts"), F.count_if(good).alias("n_good"))
    if strata is not None:
        out = out.join(rows.select(arm, F.explode_outer(strata).alias("_s")).groupBy(arm).agg(F.count_distinct("_s").alias("n_strata")), arm)
    if order is not None and item is not None:
        out = out.join(order_hash(rows, [arm], order, item).select(arm, "order_sha256"), arm)
    return out


def two_arm_verdict(metrics: DataFrame, arm: str, base: str, other: str, max_drop: float, least: float, gain: float, max_lost: int | None = None, hosts: int | None = None, strata: int | None = None) -> DataFrame:
    """One row: share_a, share_b and the verdict of arm b against arm a.

    INVALID where b's mean score falls by more than `max_drop`, its matches (n_matched) by more than `max_lost`, or an arm has
    fewer hosts or strata than asked; PASS where b's share is at least `least` and its gain at least `gain`, PARTIAL for one of both.
    """
    pick = lambda name, c: F.max(F.when(F.col(arm) == name, c))
    share = F.try_divide(F.col("n_good"), F.col("n"))
    wanted = [
        pick(base, share).alias("share_a"), pick(other, share).alias("share_b"), (pick(base, F.col("mean_score")) - pick(other, F.col("mean_score"))).alias("mean_drop"),
        *([(pick(base, F.col("n_matched")) - pick(other, F.col("n_matched"))).alias("lost")] if max_lost is not None else []), *([F.min(F.when(F.col(arm).isin(base, other), F.col("n_hosts"))).alias("least_hosts")] if hosts is not None else []),
        *([F.min(F.when(F.col(arm).isin(base, other), F.col("n_strata"))).alias("least_strata")] if strata is not None else []),
    ]
    got = metrics.agg(*wanted)
    bad = F.col("mean_drop") > max_drop
    for name, limit, worse in (("lost", max_lost, F.col("lost") > (max_lost or 0)), ("least_hosts", hosts, F.col("least_hosts") < (hosts or 0)), ("least_strata", strata, F.col("least_strata") < (strata or 0))):
        bad = bad | F.coalesce(worse, F.lit(True)) if limit is not None else bad
    high, better = F.col("share_b") >= least, F.col("share_b") - F.col("share_a") >= gain - 1e-12
    verdict = F.when(bad, "INVALID").when(high & better, "PASS").when(high | better, "PARTIAL").otherwise("FAIL")
    return got.withColumn("verdict", verdict)


#: What the three comparisons ask for.
OPEN_ACCESS = {"max_drop": 5.0, "least": 0.80, "gain": 0.20, "max_lost": 2, "hosts": 5, "strata": 4}
HYBRID = {"max_drop": 3.0, "least": 0.75, "gain": 0.10, "max_lost": 2, "hosts": 6, "strata": 5}
PREVERIFIED = {"size": 20, "max_drop": 3.0, "max_lost": 2, "hosts": 6, "strata": 5, "gain": 0.20, "requests": 5.0}


def preverified_verdict(base: DataFrame, members: DataFrame, requests: Column | int) -> DataFrame:
    """One row: the verdict of the first `size` verified members (item, score, year, host, strata, matched, verified) against the base arm (n, n_good, mean_score, n_matched).

    FAIL with fewer verified members; INVALID where a guard of PREVERIFIED fails; PASS for a gain above `gain` and at most `requests` requests a member, PARTIAL for one of both.
    """
    size = PREVERIFIED["size"]
    chosen = members.where("verified").orderBy(F.desc("score"), F.desc("year"), "item").limit(size)
    own = chosen.agg(F.count(F.lit(1)).alias("v_n"), F.avg("score").alias("v_mean"), F.count_if("matched").alias("v_matched"), F.count_distinct("host").alias("v_hosts"))
    strata = chosen.select(F.explode("strata").alias("_s")).agg(F.count_distinct("_s").alias("v_strata"))
    one = base.select(F.try_divide("n_good", "n").alias("share_a"), "mean_score", "n_matched").limit(1)
    met = own.crossJoin(strata).crossJoin(one)  # three rows of one
    delta, cost = 1.0 - F.col("share_a"), F.lit(requests) / F.col("v_n") if not isinstance(requests, Column) else requests / F.col("v_n")
    sound = (F.col("v_mean") >= F.col("mean_score") - PREVERIFIED["max_drop"]) & (F.col("v_matched") >= F.col("n_matched") - PREVERIFIED["max_lost"]) & (F.col("v_hosts") >= PREVERIFIED["hosts"]) & (F.col("v_strata") >= PREVERIFIED["strata"])
    gained, cheap = delta > PREVERIFIED["gain"], cost <= PREVERIFIED["requests"]
    verdict = F.when(F.col("v_n") < size, "FAIL").when(~F.coalesce(sound, F.lit(False)), "INVALID").when(gained & cheap, "PASS").when(gained | cheap, "PARTIAL").otherwise("FAIL")
    return met.select("v_n", "share_a", F.when(F.col("v_n") >= size, delta).alias("delta"), F.when(F.col("v_n") >= size, cost).alias("cost"), verdict.alias("verdict"))


def gate(complete: Column, passed: Column) -> Column:
    """FAIL, INCOMPLETE or PASS."""
    return F.when(~F.coalesce(passed, F.lit(False)) & F.coalesce(complete, F.lit(False)), "FAIL").when(~F.coalesce(complete, F.lit(False)), "INCOMPLETE").otherwise("PASS")


def weight_grid(candidates: DataFrame, weights: list[int], k: int, score: str, bonus: str, good: str, item: str, host: str | None = None, hosts: int = 0, max_drop: float | None = None) -> DataFrame:
    """(weight, n_good, mean_score, viable, chosen): the k best under each weight of the bonus.

    A weight is viable if its picks have `hosts` hosts and a mean score at most `max_drop` below that of the first weight; the
    choice among the viable goes by goods, score, weight. The weights are a short list; each weight's top k is a limit of its own, for which a task
    holds k rows and sorts nothing.
    """
    graded = [candidates.withColumn("weight", F.lit(w)).withColumn("_s", F.col(score) + F.col("weight") * F.col(bonus)) for w in dict.fromkeys(weights)]
    best = functools.reduce(DataFrame.unionByName, [g.orderBy(F.desc("_s"), item).limit(k) for g in graded])
    got = best.groupBy("weight").agg(F.sum(good).alias("n_good"), F.avg(score).alias("mean_score"), (F.count_distinct(host) if host else F.lit(0)).alias("_hosts"))
    base = F.max(F.when(F.col("weight") == weights[0], F.col("mean_score"))).over(Window.partitionBy())  # one row a weight
    viable = (F.col("_hosts") >= hosts) & ((base - F.col("mean_score") <= max_drop) if max_drop is not None else F.lit(True))
    placed = got.withColumn("viable", viable)
    chosen = (F.row_number().over(Window.orderBy(F.desc("viable"), F.desc("n_good"), F.desc("mean_score"), "weight")) == 1) & F.col("viable")
    return placed.withColumn("chosen", chosen).drop("_hosts")


def usage_rollup(events: DataFrame, task: str, role: str, read: str, cached: str, made: str) -> DataFrame:
    """Sums by (task, role) and in total, with uncached input, the proxy cost and the share of cache hits."""
    base = events.select(F.col(task).alias("task"), F.col(role).alias("role"), F.col(read).alias("_r"), F.col(cached).alias("_c"), F.col(made).alias("_m"))
    by = base.groupingSets([["task", "role"], []], "task", "role").agg(F.count(F.lit(1)).alias("events"), F.sum("_r").alias("raw_input"), F.sum("_c").alias("_c"), F.sum("_m").alias("output"))
    return by.select("task", "role", "events", "raw_input", "output", (F.col("raw_input") - F.col("_c")).alias("uncached"), (F.col("raw_input") - F.col("_c") + F.col("output")).alias("proxy"), F.round(F.try_divide(F.col("_c"), F.col("raw_input")), 6).alias("cache_hit"))


def budget_reasons(usage: DataFrame, roles: list[str], max_events: int, max_proxy: float) -> DataFrame:
    """`usage` with the reasons that speak against it and the verdict."""
    found = reasons((~F.col("role").isin(roles), "ROLE_NOT_ALLOWED"), (F.col("events") > max_events, "TOO_MANY_EVENTS"), (F.col("proxy") >= max_proxy, "BUDGET_EXCEEDED"))
    return usage.withColumn("reasons", found).withColumn("verdict", F.when(F.size("reasons") == 0, "PASS").otherwise("FAIL"))
