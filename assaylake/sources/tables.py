"""Ledgers, usage logs, curve files, markdown pages, exchange packages and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.functions.text import utc_time
from assaylake.operators.contracts import foreign_key, union_all

CURVE_SCHEMA = "x double, y double, pixel_x double, pixel_y double, gap_before int"
FAULT_SCHEMA = (
    "event_id string, fault_id string, test_run_id string, fingerprint string, event string, status string, kind string, severity string, occurrence_type string, summary string, evidence_paths array<string>, fix_commit string, verification string, recorded_at string"
)
ROLLOUT_SCHEMA = "type string, timestamp string, payload struct<type: string, task_id: string, cwd: string, info: struct<last_token_usage: struct<input_tokens: bigint, output_tokens: bigint, cached_input_tokens: bigint, reasoning_output_tokens: bigint>>>"


def curve_points(spark: SparkSession, path: str) -> DataFrame:
    """(curve_key, ordinal, x, y, pixel_x, pixel_y, gap_before) of curve CSV files; the place of a point is its line in its file."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1).alias("curve_key"), F.posexplode(F.split(F.trim("value"), "\r?\n")).alias("ordinal", "line"))
    cells = F.from_csv("line", CURVE_SCHEMA)
    return raw.where("ordinal > 0 AND trim(line) != ''").select("curve_key", (F.col("ordinal") - 1).alias("ordinal"), cells.alias("c")).select("curve_key", "ordinal", "c.*")


def write_curves(points: DataFrame, path: str) -> None:
    """One folder of CSV files a curve, in point order."""
    points.repartition("curve_key").sortWithinPartitions("curve_key", "ordinal").drop("ordinal").write.partitionBy("curve_key").option("header", True).csv(path)


def fault_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Events of a JSON-lines ledger, each id once; a corrupt line fails the read."""
    rows = spark.read.schema(FAULT_SCHEMA).option("mode", "FAILFAST").json(path)
    return rows.dropDuplicates(["event_id"])


def append_faults(new: DataFrame, old: DataFrame) -> DataFrame:
    """The events of `new` that the ledger lacks: appending them twice changes nothing."""
    return new.dropDuplicates(["event_id"]).join(old.select("event_id"), "event_id", "left_anti")


def token_usage(lines: DataFrame, file: str, start: str, end: str, folder: str | None = None) -> DataFrame:
    """(file, task_id, at, input_tokens, cached_input_tokens, output_tokens) of token counts in [start, end).

    lines: rows of ROLLOUT_SCHEMA with a file column; `folder` keeps the files whose session record has that working folder.
    """
    if folder is not None:
        own = lines.where((F.col("type") == "session_meta") & (F.col("payload.cwd") == folder)).select(file).distinct()
        lines = lines.join(own, file, "left_semi")
    at = utc_time(F.col("timestamp"))
    use = lines.where((F.col("payload.type") == "token_count") & (at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))
    usage = F.col("payload.info.last_token_usage")
    return use.select(F.col(file), F.col("payload.task_id").alias("task_id"), at.alias("at"), *[usage[c].alias(c) for c in ("input_tokens", "cached_input_tokens", "output_tokens")])


def to_markdown(blocks: DataFrame, document: str = "document", page: str = "page", ordinal: str = "ordinal", text: str = "text") -> DataFrame:
    """(document, markdown): pages under `## Page n` headings; a text line that looks like one gets a backslash."""
    safe = F.regexp_replace(F.col(text), r"(?m)^(\\*)(## Page )", r"\\$1$2")
    pages = blocks.groupBy(document, page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), safe.alias("t")))), lambda b: b.t), "\n\n").alias("_t"))
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col("_t").alias("t")))), lambda b: F.concat(F.lit("## Page "), b.p.cast("string"), F.lit("\n"), b.t))
    return pages.groupBy(document).agg(F.array_join(body, "\n").alias("markdown"))


def from_markdown(documents: DataFrame, document: str = "document", markdown: str = "markdown") -> DataFrame:
    """(document, page, text): pages read back, with the backslashes gone."""
    parts = F.split(F.concat(F.lit("\n"), F.col(markdown)), r"\n## Page ")
    rows = documents.select(document, F.explode(F.slice(parts, F.lit(2), F.size(parts))).alias("_p"))
    body = F.substr(F.col("_p"), F.instr("_p", "\n") + 1)
    return rows.select(document, F.substring_index("_p", "\n", 1).try_cast("int").alias("page"), F.regexp_replace(body, r"(?m)^\\(\\*## Page )", "$1").alias("text"))


def write_exchange(tables: dict[str, DataFrame], edges: list[tuple[str, str, str, str]], path: str) -> DataFrame:
    """Writes the tables if no row lacks its parent; gives the counts of orphans by edge. edges: (child, parent, child key, parent key)."""
    found = union_all([foreign_key(tables[c], tables[p], ck, pk, f"{c}.{p}") for c, p, ck, pk in edges])
    if not found.where("n_orphans > 0").isEmpty():
        raise ValueError("a row has no parent; nothing was written")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return found


def manifest(files: DataFrame) -> DataFrame:
    """(path, sha256, bytes) of (path, content) rows."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"))


def freeze(df: DataFrame, path: str) -> None:
    """A write-once table: a folder that exists is an error."""
    df.write.mode("error").parquet(path)


def latest_versions(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
