"""Table cells: lookups in either orientation, anchors, table selection, reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.plans.storage import dealt

def property_cells(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(request, table_id, row, column, text, n_hits): the cell of a specimen and a property, whichever of them heads rows or columns.

    cells: table_id, row, column, text; wanted: request, table_id, specimen, property. A row header stands in column 0 with the other header above it;
    a column header stands in any other column with the other header in column 0 below it. Both are equi-joins within the table.
    """
    named = lambda p: cells.select("table_id", *[F.col(c).alias(f"{p}_{c}") for c in ("row", "column", "text")])
    ask = wanted.select("request", "table_id", "specimen", "property")
    heads = ask.join(named("p"), "table_id").where("p_text = property")
    left = heads.where("p_column = 0").join(named("s"), "table_id").where("s_text = specimen AND s_row < p_row AND s_column > 0").select("request", "table_id", F.col("p_row").alias("row"), F.col("s_column").alias("column"))
    top = heads.where("p_column > 0").join(named("s"), "table_id").where("s_text = specimen AND s_column = 0 AND s_row > p_row").select("request", "table_id", F.col("s_row").alias("row"), F.col("p_column").alias("column"))
    found = left.unionByName(top).join(cells, ["table_id", "row", "column"])
    return found.select("request", "table_id", "row", "column", "text", F.count(F.lit(1)).over(Window.partitionBy("request")).alias("n_hits"))


def one_table(captions: DataFrame, cells: DataFrame, caption_pattern: str, known: DataFrame, least: int = 2) -> DataFrame:
    """(document, table_id, status): tables whose caption matches and that hold enough known labels; SELECTED for the only one of a document, else AMBIGUOUS."""
    labels = known.select(F.col("label").alias("text")).distinct()
    counts = dealt(cells.join(labels, "text", "left_semi"), "table_id").groupBy("table_id").agg(F.count_distinct("text").alias("_n"))
    fit = captions.where(F.col("caption").rlike(caption_pattern)).join(counts.where(F.col("_n") >= least), "table_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("document"))
    return fit.select("document", "table_id", F.when(n == 1, "SELECTED").otherwise("AMBIGUOUS").alias("status"))


#: How an id names its table, row and column.
CELL_ID = r"^[^:]*:\d+:\d+$"


def normal_text(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"(?U)\s+", " ")))


def resolve_anchors(cells: DataFrame, anchors: DataFrame) -> DataFrame:
    """(table_id, anchor, ids, status) for anchors (table_id, anchor, ids array, label) on cells (table_id, id, row, column, text): see `anchored`.

    A table's cells are one row, which its anchors meet in one equi-join; all rules are functions of that row.
    """
    cell = F.struct("row", "column", F.col("id").cast("string").alias("id"), normal_text(F.col("text")).alias("t"))
    grids = cells.groupBy("table_id").agg(F.sort_array(F.collect_list(cell)).alias("grid"))
    asked = anchors.select("table_id", "anchor", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"), normal_text(F.col("label")).alias("wanted"))
    got = anchored(asked.join(grids, "table_id", "left"))
    return got.select("table_id", "anchor", F.col("found").alias("ids"), F.when(F.col("found").isNotNull(), "RESOLVED").otherwise("NOT_FOUND").alias("status"))


def anchored(rows: DataFrame) -> DataFrame:
    """`rows` (ids, wanted: a normal text, grid: row, column, id, normal text t of their table's cells in reading order) with `found`, the ids that are meant, or null.

    An anchor whose ids all exist means those. Otherwise its label is looked for: the ids that exist, if together they say it; one cell; whole cells of a row; cells
    of several rows that say it one after the other with others between them. The nearest to the place that the first well-formed id names wins, then the first in
    reading order. Only where nothing says the label, cells that contain it count. A label without words is said by nothing.
    """
    grid, wanted, columns = F.coalesce("grid", F.array().cast(rows.schema["grid"].dataType)), F.col("wanted"), rows.columns
    place = lambda i: F.get(F.regexp_extract_all(F.get(F.filter("ids", lambda x: x.rlike(CELL_ID)), F.lit(0)), F.lit(r":(\d+)"), F.lit(1)), F.lit(i)).cast("int")
    run = lambda ids, row, column: F.struct(row.cast("int").alias("row"), column.cast("int").alias("column"), ids.alias("ids"))
    alone = lambda c: run(F.array(c["id"]), c["row"], c["column"])
    rows = rows.withColumns({"_grid": grid, "_at": F.struct(place(0).alias("row"), place(1).alias("column"))}).withColumn("_have", F.flatten(F.transform("ids", lambda i: F.filter("_grid", lambda c: c["id"] == i))))
    rows = rows.withColumn("_all", (F.size("ids") > 0) & (F.size("_have") == F.size("ids"))).withColumn("_open", ~F.col("_all") & (wanted != ""))
    rows = rows.withColumn("_parts", F.when(F.col("_open"), F.filter("_grid", lambda c: (c["t"] != "") & F.contains(wanted, c["t"]))))  # all that a label over several rows can be read from
    rows = rows.withColumn("_begun", F.filter("_parts", lambda c: (c["t"] == wanted) | F.startswith(wanted, F.concat(c["t"], F.lit(" ")))))
    nothing = F.struct(wanted.alias("rest"), F.array().cast("array<string>").alias("ids"), F.array().cast(f"array<{rows.schema['grid'].dataType.elementType['row'].dataType.simpleString()}>").alias("rows"), F.lit(False).alias("lost"))

    def read(s: Column, c: Column, otherwise: Column) -> Column:
        rest = F.when(s["rest"] == c["t"], "").when(F.startswith(s["rest"], F.concat(c["t"], F.lit(" "))), F.substr(s["rest"], F.length(c["t"]) + 2))
        return F.when((s["rest"] != "") & ~s["lost"] & rest.isNotNull(), F.struct(F.coalesce(rest, F.lit("")).alias("rest"), F.concat(s["ids"], F.array(c["id"])).alias("ids"), F.concat(s["rows"], F.array(c["row"])).alias("rows"), s["lost"].alias("lost"))).otherwise(otherwise)

    def in_row(p: Column) -> Column:
        line = F.filter("_grid", lambda c: (c["row"] == p["row"]) & (c["column"] >= p["column"]) & (c["t"] != ""))
        lost = lambda s: F.when(s["rest"] == "", s).otherwise(F.struct(s["rest"].alias("rest"), s["ids"].alias("ids"), s["rows"].alias("rows"), F.lit(True).alias("lost")))
        return F.aggregate(line, nothing, lambda s, c: read(s, c, lost(s)))

    def further(p: Column) -> Column:
        later = F.filter("_parts", lambda c: (c["row"] > p["row"]) | ((c["row"] == p["row"]) & (c["column"] >= p["column"])))
        return F.aggregate(later, nothing, lambda s, c: read(s, c, s))

    part = F.filter("_begun", lambda c: c["t"] != wanted)
    rows = rows.withColumn("_in_row", F.transform(part, lambda p: F.struct(p.alias("p"), in_row(p).alias("s"))))
    rows = rows.withColumn("_further", F.transform(F.filter("_in_row", lambda x: x["s"]["rest"] != ""), lambda x: F.struct(x["p"].alias("p"), further(x["p"]).alias("s"))))  # what its row says whole would be read from the same cells
    whole = lambda found, rule: F.transform(F.filter(found, lambda x: (x["s"]["rest"] == "") & rule(x["s"])), lambda x: run(x["s"]["ids"], x["p"]["row"], x["p"]["column"]))
    first = F.get("_have", F.lit(0))
    together = F.filter(F.array(run(F.transform("_have", lambda c: c["id"]), first["row"], first["column"])), lambda r: (F.size("_have") > 1) & (F.array_join(F.transform("_have", lambda c: c["t"]), " ") == wanted))
    said = F.concat(together, F.transform(F.filter("_begun", lambda c: c["t"] == wanted), alone), whole("_in_row", lambda s: F.lit(True)), whole("_further", lambda s: F.size(F.array_distinct(s["rows"])) > 1))
    rows = rows.withColumn("_said", F.when(F.col("_open"), said))
    said = F.when(F.size("_said") > 0, F.col("_said")).when(F.col("_open"), F.transform(F.filter("_grid", lambda c: F.contains(c["t"], wanted)), alone))
    away = lambda r: F.coalesce(F.abs(r["row"] - F.col("_at")["row"]) + F.abs(r["column"] - F.col("_at")["column"]), F.lit(0))
    best = F.array_min(F.transform(said, lambda r: F.struct(away(r).alias("away"), r.alias("r"))))["r"]["ids"]
    return rows.select(*columns, F.when(F.col("_all"), F.col("ids")).otherwise(best).alias("found"))


def reading_places(blocks: DataFrame) -> DataFrame:
    """`blocks` (document, page, x0, y0, x1) with their place: by page (0 if none), then what begins left of the middle of the page's boxes, then down."""
    page = Window.partitionBy("document", F.coalesce("page", F.lit(0)))
    middle = (F.min("x0").over(page) + F.max("x1").over(page)) / 2
    right = F.coalesce(F.coalesce("x0", F.lit(0.0)) >= middle, F.lit(False))
    placed = blocks.withColumn("_right", right)
    return placed.withColumn("place", F.row_number().over(Window.partitionBy("document").orderBy(F.coalesce("page", F.lit(0)), "_right", F.coalesce("y0", F.lit(0.0)), "block"))).drop("_right")


def reading_order(blocks: DataFrame, document: str = "document") -> DataFrame:
    """`blocks` (document, page, x0, y0, x1) with their place: page, then left or right half of the page's text, then down."""
    page = Window.partitionBy(document, "page")
    middle = (F.min("x0").over(page) + F.max("x1").over(page)) / 2
    half = ((F.col("x0") + F.col("x1")) / 2 >= middle).cast("int")
    placed = blocks.withColumn("_half", half)
    return placed.withColumn("place", F.row_number().over(Window.partitionBy(document).orderBy("page", "_half", "y0", "x0"))).drop("_half")


def nearest_lane(cells: DataFrame, gap: float = 4.0) -> DataFrame:
    """`cells` (page, x, ...) with the lane they belong to: lanes open where x lies more than the gap beyond the lane's first cell."""
    from assaylake.operators.windows import leader_bands

    return leader_bands(cells, "page", ["x"], "x", gap, "lane")


def chart_backend(panels: DataFrame) -> DataFrame:
    """`panels` with the tool that reads them: by kind, whether there are vector strokes, and whether their boxes are apart.

    panels: figure, panel, kind, has_vectors, x0, y0, x1, y1. Boxes of one figure are compared with each other, a short list.
    """
    boxes = panels.groupBy("figure").agg(F.collect_list(F.struct("panel", "x0", "y0", "x1", "y1")).alias("_b"))
    met = panels.join(boxes, "figure")
    clash = F.exists("_b", lambda b: (b.panel != F.col("panel")) & (b.x0 < F.col("x1")) & (b.x1 > F.col("x0")) & (b.y0 < F.col("y1")) & (b.y1 > F.col("y0")))
    tool = F.when(clash, "manual").when(F.col("has_vectors") & F.col("kind").isin("curve", "psd"), "vector").when(F.col("kind").isin("curve", "psd", "xrd", "ftir"), "raster").when(F.col("kind") == "bar", "bars").when(F.col("kind") == "scatter", "markers").otherwise("manual")
    return met.withColumn("backend", tool).drop("_b")


def accepted_repairs(errors: DataFrame, repairs: DataFrame, facts_total: int, most: int = 10, share: float = 0.25, round_no: Column | None = None) -> DataFrame:
    """`errors` (fact, owners array, field, error) with what becomes of each: REPLACED, or KEPT with the first reason against its replacement.

    repairs: fact, owners array, field, text, source_text, error. Nothing is replaced where there are too many errors at all or the round is past the second.
    """
    from assaylake.operators.contracts import first_reason

    n = errors.count()
    blocked = n > most or (facts_total > 0 and n > share * facts_total)
    r = repairs.select("fact", F.col("owners").alias("_o"), F.col("field").alias("_f"), F.col("text").alias("_t"), F.col("source_text").alias("_s"), F.col("error").alias("_e"))
    met = errors.join(r, "fact", "left")
    late = round_no > 2 if round_no is not None else F.lit(False)
    reason = first_reason(
        (F.lit(blocked) | late, "BUDGET"), (F.col("_t").isNull(), "NO_REPLACEMENT"), (F.col("_e").isNotNull(), "STILL_WRONG"), (~F.array_sort("owners").eqNullSafe(F.array_sort("_o")), "OWNERS_CHANGED"), (~F.col("field").eqNullSafe(F.col("_f")), "FIELD_CHANGED"),
        (~F.coalesce(F.contains(F.col("_s"), F.col("_t")), F.lit(False)), "TOKEN_NOT_IN_SOURCE"),
    )
    return met.select(*errors.columns, F.when(reason.isNull(), F.col("_t")).alias("replacement"), F.when(reason.isNull(), "REPLACED").otherwise("KEPT").alias("outcome"), reason.alias("reason"))
