"""Event-sourced jobs, leases and fault families."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assaylake.plans.storage import unsent

#: Events of a fault's life.
FAULT_EVENTS = ("OBSERVED", "REOPENED", "RESOLVED", "VERIFIED", "EXERCISED")


def new_jobs(queue: DataFrame, jobs: DataFrame, key: str) -> DataFrame:
    """Jobs whose key is not queued yet, each key once: insert or do nothing."""
    return jobs.dropDuplicates([key]).join(queue.select(key), key, "left_anti")


START = {"status": "queued", "owner": None, "expires": 0.0, "attempts": 0, "refused": 0, "hits": 0, "stale": False}


def lease_step(state: dict, event: str, at: float, owner: str, lease: float, max_attempts: int) -> dict:
    """State after one event.

    LEASE is refused while another owner holds it, a cache hit where the job has succeeded, and the end of the job where no
    attempt is left. LOST says that a finished job's output is gone or changed: the job may run again, once without regard
    to its attempts. COMPLETE and FAIL count only from the holder.
    """
    held = state["status"] == "leased" and at < state["expires"]
    if event == "LOST":
        return state | {"status": "retryable", "owner": None, "stale": True} if state["status"] == "succeeded" else state
    if event == "LEASE":
        if state["status"] == "succeeded":
            return state | {"hits": state["hits"] + 1}
        if state["status"] == "dead_letter" or (held and state["owner"] != owner):
            return state | {"refused": state["refused"] + 1}
        if state["attempts"] >= max_attempts and not state["stale"]:
            return state | {"status": "dead_letter", "owner": None}
        return state | {"status": "leased", "owner": owner, "expires": at + lease, "attempts": state["attempts"] + 1, "stale": False}
    if event in ("COMPLETE", "FAIL"):
        if not held or state["owner"] != owner:
            return state | {"refused": state["refused"] + 1}
        again = "dead_letter" if state["attempts"] >= max_attempts else "retryable"
        return state | {"status": "succeeded" if event == "COMPLETE" else again, "owner": None}
    return state


def fold_leases(events: Iterable[tuple[str, float, str]], lease: float = 60.0, max_attempts: int = 3) -> dict:
    """State after a key's (event, time, owner) in time order."""
    state = dict(START)
    for event, at, owner in events:
        state = lease_step(state, event, at, owner, lease, max_attempts)
    return state


LEASE_OUT = ("status", "owner", "attempts", "refused", "hits")


def lease_states(events: DataFrame, key: str, event: str, at: str, owner: str, tie: str, lease: float = 60.0, max_attempts: int = 3) -> DataFrame:
    """(key, status, owner, attempts, refused, hits) after all events: a fold in time order.

    Events are dealt by key and sorted in each partition, so a task folds them as they stream by and holds one state, however long a key's history is.
    """
    rows = events.select(F.col(key).alias("key"), F.col(event).alias("event"), F.col(at).cast("double").alias("at"), F.col(owner).cast("string").alias("owner"), F.col(tie).alias("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        done: list[tuple] = []

        def told() -> pa.RecordBatch:
            keys, *cells = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), *[pa.array(c, t) for c, t in zip(cells, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]], names=["key", *LEASE_OUT])

        for batch in batches:
            for k, *said in zip(*[batch.column(c).to_pylist() for c in ("key", "event", "at", "owner")], strict=True):
                if state is None or k != now:
                    if state is not None:
                        done.append((now, *[state[f] for f in LEASE_OUT]))
                    now, state = k, dict(START)
                state = lease_step(state, said[0], said[1], str(said[2]), lease, max_attempts)
            if len(done) > 10_000:
                yield told()
                done.clear()
        if state is not None:
            done.append((now, *[state[f] for f in LEASE_OUT]))
        if done:
            yield told()

    kind = to_arrow_type(rows.schema["key"].dataType)
    folded = rows.repartition("key").sortWithinPartitions("key", "at", "tie").mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, status string, owner string, attempts long, refused long, hits long")
    return folded.withColumnRenamed("key", key)


#: What a journal says before a probe is sent.
START_PROBE, ADOPT, BLOCKED = "START", "ADOPT", "BLOCKED_UNCERTAIN_PROBE"


def journal_decisions(probes: DataFrame, reservations: DataFrame, completions: DataFrame, results: DataFrame) -> DataFrame:
    """`probes` (probe, binding) with decision: START where nothing was written, ADOPT where a completed entry of the same binding names the result's hash, else BLOCKED.

    reservations: probe; completions: probe, status, binding, result_sha256; results: probe, sha256. Whatever was begun and isn't proven complete is blocked.
    """
    done = completions.groupBy("probe").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("status", "binding", "result_sha256")).alias("_c"))
    held = results.groupBy("probe").agg(F.first("sha256").alias("_s"))
    begun = reservations.select("probe").distinct().withColumn("_r", F.lit(True))
    met = probes.join(done, "probe", "left").join(held, "probe", "left").join(begun, "probe", "left")
    proven = (F.col("_n") == 1) & (F.col("_c.status") == "COMPLETED") & (F.col("_c.binding") == F.col("binding")) & (F.col("_c.result_sha256") == F.col("_s"))
    untouched = F.col("_n").isNull() & F.col("_r").isNull() & F.col("_s").isNull()
    return met.select(*probes.columns, F.when(untouched, START_PROBE).when(F.coalesce(proven, F.lit(False)), ADOPT).otherwise(BLOCKED).alias("decision"))


#: The steps of a frozen comparison, in order.
ARM_STEPS = ("PREPARED", "METADATA_CACHED", "ARMS_FROZEN", "PROBED", "SUMMARIZED", "REPLAYED", "VERIFIED")


def controller_states(runs: DataFrame, steps: DataFrame, now: DataFrame) -> DataFrame:
    """`runs` (run) with next_step and error of each run.

    steps: run, step, artifact_sha256, as written; now: run, step, artifact_sha256, as recomputed from what is frozen. A run goes
    on after its last step; a step that is missing before a later one, unknown, or recomputes differently is an error.
    """
    order = F.array(*map(F.lit, ARM_STEPS))
    again = now.select("run", "step", F.col("artifact_sha256").alias("_now"))
    told = steps.withColumn("_at", F.array_position(order, F.col("step"))).join(unsent(again), ["run", "step"], "left")
    # Numbers only (a step is its place), which are folded in place; a text or a struct would be sorted by run in each task of the scan.
    got = told.groupBy("run").agg(
        F.max("_at").alias("_last"), F.bit_count(F.bit_or(F.when(F.col("_at") > 0, F.expr("shiftleft(1L, CAST(_at AS INT))")))).alias("_n"), F.count_if(F.col("_at") == 0).alias("_unknown"), F.min(F.when(F.col("_now") != F.col("artifact_sha256"), F.col("_at"))).alias("_drift")
    )
    met = runs.join(got, "run", "left")
    last = F.coalesce(F.col("_last"), F.lit(0))
    error = F.when(F.coalesce(F.col("_unknown"), F.lit(0)) > 0, "UNKNOWN_STEP").when(F.col("_n") != F.col("_last"), "MISSING_STEP").when(F.col("_drift").isNotNull(), F.concat(F.lit("REPLAY_DIFFERS:"), F.get(order, F.col("_drift").cast("int") - 1)))
    return met.select(*runs.columns, F.when(error.isNull(), F.get(order, last.cast("int"))).alias("next_step"), error.alias("error"))


def fault_transitions(events: DataFrame, fault: str, event: str, order: list[str]) -> DataFrame:
    """`events` with error: RESOLVED needs an open fault, VERIFIED a resolved one, REOPENED a closed one, a first event must be OBSERVED or EXERCISED."""
    before = F.lag(event).over(Window.partitionBy(fault).orderBy(*order))
    error = (
        F.when(~F.col(event).isin(*FAULT_EVENTS), "UNKNOWN_EVENT").when(before.isNull() & ~F.col(event).isin("OBSERVED", "EXERCISED"), "FIRST_EVENT")
        .when((F.col(event) == "VERIFIED") & (before != "RESOLVED"), "VERIFIED_WITHOUT_RESOLVED").when((F.col(event) == "RESOLVED") & before.isin("RESOLVED", "VERIFIED"), "NOT_OPEN")
        .when((F.col(event) == "REOPENED") & ~before.isin("RESOLVED", "VERIFIED"), "NOT_CLOSED")
    )
    return events.withColumn("error", error)


def unsettled_classes(events: DataFrame, fault: str, classes: list[str]) -> DataFrame:
    """(fault, column) of what a fault's first event settled and a later one says otherwise: kind, severity and the like never change."""
    seen = events.select(fault, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in classes])).alias("_c")).select(fault, "_c.*")
    return seen.groupBy(fault, "column").agg(F.count_distinct("v").alias("_n")).where("_n > 1").select(fault, "column")


def fault_report(events: DataFrame, fault: str, order: list[str], status: str, fix: str, verification: str, evidence: str, first: list[str], last: list[str]) -> DataFrame:
    """One row per fault: the `first` columns of its first event, the `last` ones of its latest, the latest known fix and verification, all evidence paths and whether it is open."""
    at = F.struct(*order)
    known = lambda c: F.max_by(F.nullif(F.col(c), F.lit("")), F.when(F.coalesce(F.col(c), F.lit("")) != "", at))
    paths = events.select(F.col(fault).alias("_f"), F.explode(evidence).alias("_e")).distinct().groupBy("_f").agg(F.array_sort(F.collect_list("_e")).alias("evidence_paths"))
    got = events.groupBy(fault).agg(
        *[F.min_by(c, at).alias(c) for c in first], *[F.max_by(c, at).alias(c) for c in last], F.max_by(status, at).alias("latest_status"), F.min(order[0]).alias("first_at"), F.max(order[0]).alias("last_at"), F.count(F.lit(1)).alias("n_events"),
        known(fix).alias("fix"), known(verification).alias("verification"),
    )
    out = got.join(paths, got[fault] == paths["_f"], "left").drop("_f").withColumn("evidence_paths", F.coalesce("evidence_paths", F.array().cast("array<string>")))
    return out.withColumn("open", ~F.col("latest_status").isin("RESOLVED", "VERIFIED", "EXERCISED"))


def fault_families(events: DataFrame, fault: str, event: str, at: str, tie: str, note: str) -> DataFrame:
    """(fault, first_at, last_at, n_events, last_event, last_note, unresolved)."""
    order = F.struct(at, tie)
    got = events.groupBy(fault).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("n_events"), F.max_by(event, order).alias("last_event"), F.max_by(note, F.when(F.col(note).isNotNull(), order)).alias("last_note")
    )
    return got.withColumn("unresolved", ~F.col("last_event").isin("VERIFIED", "EXERCISED"))


def current_artifacts(registry: DataFrame, files: DataFrame, key: str, digest: str) -> DataFrame:
    """`registry` with current: whether the file exists with the registered hash."""
    seen = files.select(key, F.col(digest).alias("_d"))
    return registry.join(seen, key, "left").withColumn("current", F.coalesce(F.col("_d") == F.col(digest), F.lit(False))).drop("_d")


def levels(edges: DataFrame, nodes: DataFrame, node: str, parent: str, child: str) -> DataFrame:
    """(node, level) of a task graph: the longest way from a root, one round a level. A cycle is an error."""
    from assaylake.plans.storage import cut

    left = cut(nodes.select(F.col(node)).distinct())
    open_edges = cut(edges.select(F.col(parent).alias("_p"), F.col(child).alias("_c")).distinct())
    done, level = None, 0
    while not left.isEmpty():
        ready = cut(left.join(open_edges, F.col(node) == F.col("_c"), "left_anti").withColumn("level", F.lit(level)))
        if ready.isEmpty():
            raise ValueError("the task graph has a cycle")
        done = ready if done is None else done.unionByName(ready)
        left = cut(left.join(ready.select(node), node, "left_anti"))
        open_edges = cut(open_edges.join(ready.select(F.col(node).alias("_p")), "_p", "left_anti"))
        level += 1
    return done if done is not None else left.withColumn("level", F.lit(0))


def resume(members: DataFrame, done: DataFrame, config: str) -> DataFrame:
    """`members` (member, content) with what to do: REUSE where the same content was finished under the same configuration, REDO where either changed, RUN for new ones.

    done: member, content, config, status.
    """
    old = done.where("status = 'DONE'").select("member", F.col("content").alias("_c"), F.col("config").alias("_f"))
    met = members.join(old, "member", "left")
    return met.select("member", "content", F.when(F.col("_c").isNull(), "RUN").when((F.col("_c") == F.col("content")) & (F.col("_f") == config), "REUSE").otherwise("REDO").alias("action"))


def ready_tasks(tasks: DataFrame, edges: DataFrame, results: DataFrame) -> DataFrame:
    """`tasks` (task, cache_key) with state: CACHED, READY where all parents have a result, BLOCKED where one failed, else WAITING.

    edges: parent, child; results: cache_key, status (DONE or FAILED).
    """
    r = results.groupBy("cache_key").agg(F.min("status").alias("_s"))
    known = tasks.join(r, "cache_key", "left")
    parents = edges.join(known.select(F.col("task").alias("parent"), F.col("_s").alias("_ps")), "parent")
    gathered = parents.groupBy(F.col("child").alias("task")).agg(F.count_if(F.col("_ps") == "FAILED").alias("_bad"), F.count_if(F.col("_ps").isNull()).alias("_open"))
    met = known.join(gathered, "task", "left")
    state = F.when(F.col("_s") == "DONE", "CACHED").when(F.coalesce("_bad", F.lit(0)) > 0, "BLOCKED").when(F.coalesce("_open", F.lit(0)) > 0, "WAITING").otherwise("READY")
    return met.select(*tasks.columns, state.alias("state"))


def replace_run(claims: DataFrame, path: str) -> None:
    """Replaces the partitions of the runs in `claims` and no others: one commit."""
    claims.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def sealed(members: DataFrame, group: str, order: str, digest: str) -> DataFrame:
    """(group, seal, n): hash over the members' hashes in order; a packet is valid while its seal comes out again. A packet is one value, so its hashes meet in one row."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, digest))), lambda m: m[digest]), "")
    return members.groupBy(group).agg(F.sha2(joined.cast("binary"), 256).alias("seal"), F.count(F.lit(1)).alias("n"))


def verify_seals(seals: DataFrame, members: DataFrame, group: str, order: str, digest: str) -> DataFrame:
    """`seals` (group, seal) with verdict: VALID, CHANGED, or GONE where no member is left."""
    now = sealed(members, group, order, digest).select(group, F.col("seal").alias("_now"))
    return seals.join(now, group, "left").select(*seals.columns, F.when(F.col("_now").isNull(), "GONE").when(F.col("_now") == F.col("seal"), "VALID").otherwise("CHANGED").alias("verdict"))


def rebound(acceptances: DataFrame, seals: DataFrame, group: str, unchanged: DataFrame) -> DataFrame:
    """`acceptances` (group, seal) bound to the current seals: kept where the seal is the same, REBOUND where `unchanged` names the group (its content was proven equal), else VOID."""
    now = seals.select(group, F.col("seal").alias("_now"))
    same = unchanged.select(group).distinct().withColumn("_same", F.lit(True))
    met = acceptances.join(now, group, "left").join(same, group, "left")
    state = F.when(F.col("_now").isNull(), "VOID").when(F.col("_now") == F.col("seal"), "KEPT").when(F.coalesce("_same", F.lit(False)), "REBOUND").otherwise("VOID")
    return met.select(group, F.when(state != "VOID", F.col("_now")).alias("seal"), state.alias("state"))


def source_signature(document: Column, pages: Column, contract: Column, model: Column) -> Column:
    """What a source response depends on: the document, its pages in order, the contract and the model. Equal signatures may share a response."""
    return F.sha2(F.to_json(F.struct(contract.alias("contract"), document.alias("document"), model.alias("model"), F.array_sort(pages).alias("pages")), {"ignoreNullFields": "false"}).cast("binary"), 256)


def reusable_responses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """`requests` (…, signature) with the response of a finished cache entry (signature, response, status) of the same signature; ambiguous entries are not used."""
    one = cache.where("status = 'DONE'").groupBy("signature").agg(F.count_distinct("response").alias("_n"), F.min("response").alias("_r"))
    return requests.join(one, "signature", "left").select(*requests.columns, F.when(F.col("_n") == 1, F.col("_r")).alias("response"), F.when(F.col("_n").isNull(), "RUN").when(F.col("_n") == 1, "REUSE").otherwise("AMBIGUOUS").alias("action"))


def slot_states(slots: DataFrame, results: DataFrame) -> DataFrame:
    """`slots` (parent, slot, needed) with state and result: FILLED by the one result of its children, OPEN without one, AMBIGUOUS with several different ones, and BLOCKED where all children failed and it is needed.

    results: parent, slot, child, status (DONE or FAILED), result.
    """
    got = results.groupBy("parent", "slot").agg(F.count_distinct(F.when(F.col("status") == "DONE", F.col("result"))).alias("_n"), F.min(F.when(F.col("status") == "DONE", F.col("result"))).alias("_r"), F.count_if(F.col("status") == "FAILED").alias("_bad"))
    met = slots.join(got, ["parent", "slot"], "left")
    n = F.coalesce("_n", F.lit(0))
    state = F.when(n == 1, "FILLED").when(n > 1, "AMBIGUOUS").when(F.coalesce("_bad", F.lit(0)) > 0, F.when(F.col("needed"), "BLOCKED").otherwise("SKIPPED")).otherwise("OPEN")
    return met.select(*slots.columns, state.alias("state"), F.when(n == 1, F.col("_r")).alias("result"))


#: What a batch member's work writes down, in order.
POINTS = ("STARTED", "WRITTEN", "VERIFIED", "COMMITTED")


def after_crash(members: DataFrame, journal: DataFrame, files: DataFrame, config: str) -> DataFrame:
    """`members` (member, content) with the last point that holds and what to do after a crash.

    journal: member, point, content, config, sha256; files: member, sha256. Points of another content or configuration count for nothing. A
    point holds if all before it do and, from WRITTEN on, the file is there with the hash that was written down. COMMITTED is REUSE, VERIFIED is
    COMMIT, WRITTEN is VERIFY; anything else is RUN.
    """
    mine = journal.join(members.select("member", F.col("content").alias("_c")), "member").where((F.col("content") == F.col("_c")) & (F.col("config") == config))
    held = mine.groupBy("member").agg(F.collect_set("point").alias("_p"), F.max("sha256").alias("_s"), F.count_distinct("sha256").alias("_n"))
    seen = files.groupBy("member").agg(F.max("sha256").alias("_f"))
    met = members.join(held, "member", "left").join(seen, "member", "left")
    sound = F.coalesce((F.col("_n") == 1) & (F.col("_f") == F.col("_s")), F.lit(False))
    upto = lambda k: F.coalesce(F.size(F.array_intersect("_p", F.array(*map(F.lit, POINTS[:k])))) == k, F.lit(False))
    last = F.when(upto(4) & sound, "COMMITTED").when(upto(3) & sound, "VERIFIED").when(upto(2) & sound, "WRITTEN").when(upto(1), "STARTED")
    action = F.when(last == "COMMITTED", "REUSE").when(last == "VERIFIED", "COMMIT").when(last == "WRITTEN", "VERIFY").otherwise("RUN")
    return met.select(*members.columns, last.alias("point"), action.alias("action"))
