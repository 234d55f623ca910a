"""Facts of running text with the boxes of the words that print them.

words: document, page, place, text, x0, y0, x1, y1. A page's text is its words in order with one space between; every word keeps its offsets. A sentence shape is a
list of parts in order, each with a pattern and maybe a role, so that a part's offsets follow from the lengths before it. Spans of facts meet the
offsets of words in an interval join: both sides are dealt to buckets of offsets, so it is an equi-join and no page is paired with itself.

Defined cases: words without text are left out; pages whose text matches nothing have no rows; a part that spans words has the box around all of them, words
without boxes give null ones; matches do not overlap (leftmost first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import NUMBER
from assaylake.plans.storage import unsent

BUCKET = 64
PERCENT = r"\s*(?:wt\.?\s*)?%"
#: Shapes of sentences about phases: (role or None, pattern) in order.
SHAPES: dict[str, list[tuple[str | None, str]]] = {
    "aggregate": [("material", r"\b[A-Z][\w-]*(?: [\w-]+)?"), (None, r" (?:contain(?:s|ed)|consist(?:s|ed) of|had) "), ("crystalline", NUMBER), (None, PERCENT + r" crystalline(?: phases?)?,? and "), ("amorphous", NUMBER), (None, PERCENT + r" amorphous\b")],
    "direct": [("material", r"\b[A-Z][\w-]*(?: [\w-]+)?"), (None, r" (?:contain(?:s|ed)|consist(?:s|ed) of|had) "), ("value1", NUMBER), (None, PERCENT + " "), ("phase1", r"(?!crystalline|amorphous)[a-z]+"), (None, r",? and "), ("value2", NUMBER), (None, PERCENT + " "), ("phase2", r"(?!crystalline|amorphous)[a-z]+")],
    "single_amorphous": [(None, r"\b[Aa]morphous (?:content|fraction) of "), ("material", r"[A-Z][\w-]*(?: [\w-]+)?"), (None, r" (?:was|is) "), ("qualifier", r"(?:about|approximately|around|nearly|over|below)?"), (None, r" ?"), ("value", NUMBER), (None, PERCENT)],
}


def page_texts(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(document, page, text) of pages, and the words with their offsets lo to hi in it."""
    own = words.where("length(text) > 0")
    order = Window.partitionBy("document", "page").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = own.withColumn("hi", (F.sum(F.length("text") + 1).over(order) - 1).cast("int")).withColumn("lo", (F.col("hi") - F.length("text")).cast("int"))
    texts = placed.groupBy("document", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "lo", "text"))), lambda w: w["text"]), " ").alias("text"))
    return texts, placed


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct(lo, hi)> of all matches of a pattern without groups that capture: a text is what lies between its matches, and these."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.array().cast("array<struct<lo:int,hi:int>>").alias("all"))

    def step(s: Column, match: Column) -> Column:
        lo = s["at"] + F.length(F.get(between, s["i"]))
        hi = lo + F.length(match)
        return F.struct((s["i"] + 1).alias("i"), hi.alias("at"), F.concat(s["all"], F.array(F.struct(lo.alias("lo"), hi.alias("hi")))).alias("all"))

    return F.aggregate(found, start, step, lambda s: s["all"])


def fact_spans(texts: DataFrame, shapes: dict[str, list[tuple[str | None, str]]] = SHAPES) -> DataFrame:
    """(document, page, shape, fact, role, lo, hi, snippet): the named parts of all matches; facts of a page and shape are numbered from 1."""
    out = None
    for shape, parts in shapes.items():
        whole = "".join(f"(?:{p})" for _, p in parts)
        split = "".join(f"({p})" for _, p in parts)
        facts = texts.where(F.col("text").rlike(whole)).select("document", "page", "text", F.posexplode(spans_of(F.col("text"), whole)).alias("n", "s"))
        facts = facts.select("document", "page", (F.col("n") + 1).alias("fact"), "s.lo", F.substr("text", F.col("s.lo") + 1, F.col("s.hi") - F.col("s.lo")).alias("said"))
        read = [F.regexp_extract("said", split, i + 1) for i in range(len(parts))]
        cells, before = [], F.col("lo")
        for (role, _), got in zip(parts, read, strict=True):
            if role:
                cells.append(F.struct(F.lit(role).alias("role"), before.alias("lo"), (before + F.length(got)).alias("hi"), got.alias("snippet")))
            before = before + F.length(got)
        one = facts.select("document", "page", F.lit(shape).alias("shape"), "fact", F.explode(F.array(*cells)).alias("c")).select("document", "page", "shape", "fact", "c.*").where("snippet != ''")
        out = one if out is None else out.unionByName(one)
    return out


def boxed(spans: DataFrame, placed: DataFrame) -> DataFrame:
    """`spans` (document, page, lo, hi, ...) with x0, y0, x1, y1 around the words that they meet."""
    buckets = lambda: F.explode(F.sequence(F.floor(F.col("lo") / BUCKET), F.floor((F.col("hi") - 1) / BUCKET))).alias("_b")
    keys = spans.columns
    w = placed.select("document", "page", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "x0", "y0", "x1", "y1", buckets())
    met = spans.select(*keys, buckets()).join(unsent(w), ["document", "page", "_b"]).where("_lo < hi AND _hi > lo")
    return met.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))  # a word that two buckets hold counts twice, to no effect


def phase_facts(words: DataFrame, tolerance: float = 0.11) -> DataFrame:
    """(document, page, shape, fact, role, snippet, x0, y0, x1, y1, total, status) of phases that sentences report.

    total adds up an aggregate's shares; status is INCONSISTENT where it is not 100 within the tolerance or a share is no percentage, else CANDIDATE. Complements are never inferred.
    """
    texts, placed = page_texts(words)
    found = boxed(fact_spans(texts), placed)
    fact = Window.partitionBy("document", "page", "shape", "fact")
    share = F.when(F.col("role").isin("crystalline", "amorphous", "value", "value1", "value2"), F.col("snippet").try_cast("double"))
    total = F.when(F.col("shape") == "aggregate", F.sum(share).over(fact))
    wrong = F.max((~share.between(0, 100)).cast("int")).over(fact) == 1
    status = F.when(F.coalesce(wrong, F.lit(False)) | F.coalesce(F.abs(total - 100) > tolerance, F.lit(False)), "INCONSISTENT").otherwise("CANDIDATE")
    return found.withColumns({"total": total, "status": status}).drop("lo", "hi")


def outside_regions(blocks: DataFrame, regions: DataFrame, pad: float = 2.0, cell: float = 64.0) -> DataFrame:
    """`blocks` (document, page, x0, y0, x1, y1, ...) that lie in no region of their page, each grown by the pad; a block without a box lies in none.

    A region is dealt to the grid cells that it touches and a block to the cell of its upper left corner: an anti join by document, page and cell, which adaptive execution splits where many blocks share a cell.
    """
    grown = regions.select(F.col("document").alias("_d"), F.col("page").alias("_p"), (F.col("x0") - pad).alias("_x0"), (F.col("y0") - pad).alias("_y0"), (F.col("x1") + pad).alias("_x1"), (F.col("y1") + pad).alias("_y1")).dropna()
    across, down = (F.explode(F.sequence(F.floor(F.col(f"_{c}0") / cell), F.floor(F.col(f"_{c}1") / cell))) for c in "xy")
    grid = grown.withColumn("_cx", across).withColumn("_cy", down)
    here = (F.col("document") == F.col("_d")) & (F.col("page") == F.col("_p")) & (F.floor(F.col("x0") / cell) == F.col("_cx")) & (F.floor(F.col("y0") / cell) == F.col("_cy"))
    return blocks.join(grid, here & (F.col("x0") >= F.col("_x0")) & (F.col("y0") >= F.col("_y0")) & (F.col("x1") <= F.col("_x1")) & (F.col("y1") <= F.col("_y1")), "left_anti")


def reading_scope(blocks: DataFrame, regions: DataFrame, order: list[str], start: Column, end: Column, always: Column) -> DataFrame:
    """Blocks between a start and the next end, without table text; a document without a start is read as a whole, and `always` (captions, notes) is kept everywhere.

    Text inside a table neither is kept nor ends the scope.
    """
    prose = outside_regions(blocks, regions)
    document = Window.partitionBy("document")
    up_to = document.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    told = prose.withColumn("_on", F.last(F.when(start, True).when(end, False), ignorenulls=True).over(up_to)).withColumn("_any", F.max(start.cast("int")).over(document))
    return told.where((F.coalesce("_any", F.lit(0)) == 0) | F.coalesce("_on", F.lit(False)) | F.coalesce(always, F.lit(False))).drop("_on", "_any")
