"""The named checks of a run over its tables: what exists, what agrees, what refers to what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.operators.claims import provenance_reason, validate
from assaylake.operators.contracts import set_difference

#: Checks whose outcome the caller measures on files and stores, as rows (name, passed).
MEASURED = (
    "manifest_exists", "control_state_exists", "claims_exists", "records_exists", "sqlite_exists", "platform_contract", "claims_hash", "records_hash",
    "sqlite_integrity", "sqlite_foreign_keys", "sqlite_readable", "control_sqlite_integrity", "control_sqlite_foreign_keys", "control_sqlite_readable",
    "snapshot_manifest_exists", "snapshot_manifest_hash",
)
#: Without these nothing else is checked.
FIRST = MEASURED[:5]
TOLERANCE = 1e-9


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias("_p")).distinct(), F.col(child_key) == F.col("_p"), "left_anti")


def unless(counted: DataFrame, good: Column) -> DataFrame:
    """The one row of a count where it is not as it should be."""
    return counted.where(~F.coalesce(good, F.lit(False)))


def count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"))


def same_count(a: DataFrame, b: DataFrame, extra: int = 0) -> DataFrame:
    """One row if the numbers of rows differ."""
    return a.select(F.lit(1).alias("d")).unionByName(b.select(F.lit(-1).alias("d"))).agg(F.coalesce(F.sum("d"), F.lit(0)).alias("n")).where(F.col("n") != extra)


def record_checks(t: dict[str, DataFrame], max_page: Column | None = None) -> dict[str, DataFrame]:
    """Named tables of defects of a run's records.

    t: papers (paper_key), mats (mat_key, paper_key, original_total, normalised, original_value, specific_surface), mixes (mix_key,
    paper_key), mat_refs (mix_key, mat_key), required, provenance, evidence (see `provenance_reason`; evidence has asset_key too),
    assets (asset_key, path, sha256), files (path, sha256), candidates (status, blocks_record, reason), claims, assembled and
    records (record_key, field_path, value), stored_claims, stored_issues, versions.
    """
    surface = F.col("original_value") * 0.1
    off = (F.abs(surface - F.col("specific_surface")) > TOLERANCE) | (F.abs(F.col("specific_surface") / 0.1 - F.col("original_value")) > TOLERANCE)
    files = t["assets"].join(t["files"].select("path", F.col("sha256").alias("_seen")), "path", "left")
    leaf = ["record_key", "field_path", "value"]
    return {
        "claim_assembly_roundtrip": set_difference(t["assembled"].select(F.struct(*leaf).alias("leaf")), t["records"].select(F.struct(*leaf).alias("leaf")), "leaf"),
        "has_one_paper": unless(count(t["papers"]), F.col("n") == 1),
        "has_mat": unless(count(t["mats"]), F.col("n") >= 1),
        "has_mix": unless(count(t["mixes"]), F.col("n") >= 1),
        "unique_paper_keys": repeated(t["papers"], "paper_key"),
        "unique_mat_keys": repeated(t["mats"], "mat_key"),
        "mat_paper_references": orphans(t["mats"], t["papers"], "paper_key", "paper_key"),
        "mix_paper_references": orphans(t["mixes"], t["papers"], "paper_key", "paper_key"),
        "mix_mat_references": orphans(t["mat_refs"], t["mats"], "mat_key", "mat_key"),
        "field_provenance": provenance_reason(t["required"], t["provenance"], t["evidence"].drop("asset_key"), max_page if max_page is not None else F.lit(1 << 30)).where("reason IS NOT NULL"),
        "asset_links_and_hashes": orphans(t["evidence"], t["assets"], "asset_key", "asset_key").select("asset_key").unionByName(files.where("_seen IS NULL OR _seen != sha256").select("asset_key")),
        "no_unconfirmed_blocking_candidates": t["candidates"].where("blocks_record AND NOT status <=> 'confirmed'"),
        "xrf_total_gate": t["mats"].where("original_total > 100 AND NOT coalesce(normalised, false)"),
        "unit_conversion_roundtrip": t["mats"].where(off),
        "claims_persisted": same_count(t["stored_claims"], t["claims"]),
        "issues_persisted_once": same_count(t["stored_issues"], t["candidates"].where("coalesce(reason, '') != ''")),
        "record_version_persisted": unless(count(t["versions"]), F.col("n") == 1),
        "source_integrity": t["records"].where("record_key IS NULL OR field_path IS NULL"),
    }


def run_checks(measured: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(check, defects, verdict, fingerprint) of all named checks; only the first five where one of these fails (one small lookup)."""
    failed = {r["name"] for r in measured.where("NOT passed").select("name").distinct().collect()}  # of MEASURED at most
    names = FIRST if failed & set(FIRST) else MEASURED
    parts = {n: measured.where((F.col("name") == n) & ~F.col("passed")) for n in names}
    return validate(parts if names is FIRST else parts | record_checks(tables))
