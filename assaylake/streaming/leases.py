"""Leases and fault states over unbounded streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from assaylake.operators.control import START, lease_step

LEASE_STATE = "status string, owner string, expires double, attempts long, refused long, hits long, stale boolean"
FIELDS = ("status", "owner", "expires", "attempts", "refused", "hits", "stale")


def lease_stream(events: DataFrame, key: str, event: str, at: str, owner: str, lease: float = 60.0, max_attempts: int = 3) -> DataFrame:
    """(key, status, owner, attempts, refused) after each batch of each key's events; state is one small row a key."""
    kind = events.schema[key].dataType.simpleString()

    def run(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = dict(zip(FIELDS, state.get, strict=True)) if state.exists else dict(START)
        rows = pd.concat(list(batches)).sort_values(at, kind="stable")
        for e, t, o in zip(rows[event], rows[at].astype(float), rows[owner].astype(str), strict=True):
            now = lease_step(now, e, t, o, lease, max_attempts)
        state.update(tuple(now[f] for f in FIELDS))
        yield pd.DataFrame([{key: group[0], "status": now["status"], "owner": now["owner"], "attempts": now["attempts"], "refused": now["refused"]}])

    return events.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, status string, owner string, attempts long, refused long", LEASE_STATE, "update", GroupStateTimeout.NoTimeout)


def ledger_stream(events: DataFrame, event_id: str, at: str, late: str = "1 hour") -> DataFrame:
    """Each event once within the watermark: repeated deliveries of an id are dropped by state that expires."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([event_id])


def windowed_counts(events: DataFrame, at: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, kind, n, total): tumbling windows that close with the watermark."""
    got = events.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return got.select(F.col("window.start").alias("window_start"), kind, "n", "total")


def open_faults(states: DataFrame, fault: str, event: str, at: str) -> DataFrame:
    """(fault, last_event) so far; a running aggregate for complete or update mode."""
    return states.groupBy(fault).agg(F.max_by(event, at).alias("last_event"), F.count(F.lit(1)).alias("n_events"))

