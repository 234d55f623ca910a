"""Pictures drawn from rows of the test tables and read back: one picture for each supplier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import ink
from assaylake.plans.registry import query, table


def span(a: Column | int, b: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(a) if isinstance(a, int) else a, F.lit(b) if isinstance(b, int) else b))


@query("""
SELECT s_suppkey AS image, 20 AS axis_x, CAST(i + 1 AS INTEGER) AS place, 8 + (8 + s_suppkey % 5) * i + 0.5 AS y, 4 AS length
FROM supplier, range(6) AS t(i) WHERE s_suppkey % 6 <> 0 AND i < 3 + s_nationkey % 4
""")
def axis_tick_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An axis two pixels wide with ticks four pixels long, shorter ones between them, and labels beside it; every sixth has no ticks."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (8 + F.col("s_suppkey") % 5).alias("g"), (3 + F.col("s_nationkey") % 4).cast("long").alias("n"))
    line = s.select("image", span(5, 75).alias("y")).select("image", F.explode(F.array(F.lit(20), F.lit(21))).alias("x"), "y")
    marks = s.where("image % 6 != 0").select("image", "g", span(F.lit(0).cast("long"), F.col("n") - 1).alias("i"))
    major = marks.select("image", F.explode(F.array(8 + F.col("g") * F.col("i"), 9 + F.col("g") * F.col("i"))).alias("y")).select("image", span(16, 19).alias("x"), "y")
    minor = marks.where("i > 0").select("image", (F.col("g") * F.col("i") + 11 - F.col("g")).alias("y")).select("image", span(18, 19).alias("x"), "y")
    label = s.select("image", span(10, 60).alias("y")).where("y % 9 < 5").select("image", span(8, 11).alias("x"), "y")
    pixels = line.unionByName(major).unionByName(minor).unionByName(label)
    return ink.axis_ticks(pixels).select("image", "axis_x", F.col("place").cast("int").alias("place"), "y", F.col("length").cast("int").alias("length"))


@query("SELECT s_suppkey AS image, 2 AS n_marks, 2 AS n_near FROM supplier")
def touching_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two discs of one size that overlap, touch or stand side by side; marks within a pixel of a drawn centre are near."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (4 + F.col("s_nationkey") % 4).cast("long").alias("r"))
    s = s.withColumn("s", F.col("r") + 3 + F.col("image") % (F.col("r") - 1))
    centres = s.select("image", "r", F.explode(F.array(F.lit(20).cast("long"), 20 + F.col("s"))).alias("cx"))
    across = centres.select("image", "r", "cx", span(F.col("cx") - F.col("r"), F.col("cx") + F.col("r")).alias("x"))
    discs = across.select("image", "r", "cx", "x", span(20 - F.col("r"), 20 + F.col("r")).alias("y")).where("(x - cx) * (x - cx) + (y - 20) * (y - 20) <= r * r")
    found = ink.separated_marks(discs.select("image", "x", "y")).join(s, "image")
    near = (F.abs(F.col("y") - 20) <= 1) & (F.least(F.abs(F.col("x") - 20), F.abs(F.col("x") - 20 - F.col("s"))) <= 1)
    return found.groupBy("image").agg(F.count(F.lit(1)).cast("int").alias("n_marks"), F.count_if(near).cast("int").alias("n_near"))


COLOURS = [("paper", 255, 255, 255), ("A", 200, 30, 30), ("N", 30, 160, 30), ("R", 30, 30, 200)]


@query("""
WITH c AS (SELECT l_suppkey AS image, l_linenumber AS line, l_returnflag AS colour, 2 + count(*) % 9 AS h FROM lineitem GROUP BY ALL),
p AS (SELECT *, sum(h) OVER (PARTITION BY image, line ORDER BY colour) AS up, dense_rank() OVER (PARTITION BY image ORDER BY line) AS bar, row_number() OVER (PARTITION BY image, line ORDER BY colour) AS layer FROM c)
SELECT image, CAST(bar AS INTEGER) AS bar, CAST(layer AS INTEGER) AS layer, colour, CAST(line * 6 AS BIGINT) AS x0, CAST(line * 6 + 3 AS BIGINT) AS x1, CAST(90 - up AS DOUBLE) AS top, CAST(89 - up + h AS DOUBLE) AS bottom FROM p
""")
def histogram_stacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each supplier a bar for each line number with a layer for each return flag, its colours a little off, and a legend above."""
    from pyspark.sql import Window

    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("image"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("colour")).agg((2 + F.count(F.lit(1)) % 9).alias("h"))
    up = counts.withColumn("up", F.sum("h").over(Window.partitionBy("image", "line").orderBy("colour")))
    rgb = F.map_from_entries(F.array(*[F.struct(F.lit(n), F.struct(F.lit(r).alias("r"), F.lit(g).alias("g"), F.lit(b).alias("b"))) for n, r, g, b in COLOURS]))
    tall = up.select("image", "line", "colour", span(90 - F.col("up"), 89 - F.col("up") + F.col("h")).alias("y"))
    bars = tall.select("image", "y", "colour", span(F.col("line").cast("long") * 6, F.col("line").cast("long") * 6 + 3).alias("x"))
    legend = counts.select("image", "colour").distinct().select("image", "colour", span(F.lit(5).cast("long"), F.lit(9).cast("long")).alias("y")).select("image", "y", "colour", span(F.lit(10).cast("long"), F.lit(14).cast("long")).alias("x"))
    off = (F.col("x") + F.col("y")) % 7
    pixels = bars.unionByName(legend.where("colour = 'R'")).withColumn("c", rgb[F.col("colour")]).select("image", "x", "y", (F.col("c.r") - off).alias("r"), (F.col("c.g") + off).alias("g"), (F.col("c.b") - off).alias("b"))
    found = ink.stacked_columns(pixels, COLOURS, "paper", baseline=89)
    return found.select("image", F.col("bar").cast("int").alias("bar"), F.col("layer").cast("int").alias("layer"), "colour", F.col("x0").cast("long").alias("x0"), F.col("x1").cast("long").alias("x1"), "top", "bottom")


def bent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, x, y): one line for each supplier that falls, then rises."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (10 + F.col("s_nationkey")).cast("long").alias("b"), (1 + F.col("s_suppkey") % 3).alias("up"), (1 + F.col("s_nationkey") % 3).alias("down"))
    return s.select("image", "b", "up", "down", span(F.lit(0).cast("long"), F.col("b") + 20).alias("x")).select("image", "x", F.when(F.col("x") <= F.col("b"), 100 - F.col("down") * F.col("x")).otherwise(100 - F.col("down") * F.col("b") + F.col("up") * (F.col("x") - F.col("b"))).alias("y"))


@query("""
SELECT s_suppkey AS image, 1 AS piece, CAST(0 AS BIGINT) AS x0, CAST(9 + s_nationkey AS BIGINT) AS x1, CAST(-(1 + s_nationkey % 3) AS DOUBLE) AS slope FROM supplier
UNION ALL SELECT s_suppkey, 2, 10 + s_nationkey, 30 + s_nationkey, 1 + s_suppkey % 3 FROM supplier
""")
def straight_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bent_lines(spark, sf_dir).withColumn("component", F.lit(1).cast("long"))
    return ink.straight_split(lines).select("image", "piece", "x0", "x1", F.round("slope", 6).alias("slope"))


@query("""
SELECT s_suppkey AS image, kind, n FROM supplier, (VALUES ('straight', 2), ('curve', 1), ('short', 1), ('faint', 1)) AS t(kind, n) WHERE kind <> 'faint' OR s_suppkey % 4 <> 0
""")
def stroke_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame of two long lines, a slanting curve, a dash, a speck, and a pale dash (for every fourth so near to the frame that it is its rim)."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (F.col("s_nationkey") % 5).cast("long").alias("k"))
    long_ = lambda n: F.lit(n).cast("long")
    grey = lambda df, g: df.select("image", "x", "y", F.lit(g).alias("grey"))
    level = grey(s.select("image", span(long_(20), long_(90)).alias("x"), long_(120).alias("y")), 20)
    upright = grey(s.select("image", long_(5).alias("x"), span(long_(10), long_(80)).alias("y")), 20)
    curve = grey(s.select("image", "k", span(long_(20), long_(60)).alias("x")).select("image", "x", F.floor(F.lit(30) + (F.col("x") - 20) * (F.col("k") + 2) / 8).alias("y")), 60)
    short = grey(s.select("image", span(long_(70), 76 + F.col("k")).alias("x"), long_(20).alias("y")), 90)
    speck = grey(s.select("image", span(long_(90), long_(92)).alias("x")).select("image", "x", span(long_(50), long_(52)).alias("y")), 90)
    pale = grey(s.select("image", span(long_(40), long_(60)).alias("x"), F.when(F.col("image") % 4 == 0, 119).otherwise(100).cast("long").alias("y")), 200)
    pixels = level.unionByName(upright).unionByName(curve).unionByName(short).unionByName(speck).unionByName(pale)
    return ink.stroke_scan(pixels).groupBy("image", "kind").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("""
WITH m AS (SELECT event_id, user_id, value, floor(200.5 - 20 * log10(1 + abs(value))) AS y FROM events WHERE value IS NOT NULL),
t AS (SELECT DISTINCT user_id, 20.0 * i AS pixel, 10 - i + CASE WHEN user_id % 5 = 0 AND i = 3 THEN 2 ELSE 0 END AS v FROM events, range(10) AS t(i)),
f AS (SELECT user_id, regr_slope(v, pixel) AS b, regr_intercept(v, pixel) AS a FROM t GROUP BY user_id),
r AS (SELECT f.user_id, a, b, max(abs(v - a - b * pixel) / abs(b)) AS off FROM f JOIN t USING (user_id) GROUP BY ALL)
SELECT event_id, CASE WHEN off <= 2 THEN round(a + b * y, 6) END AS log_value, CASE WHEN off <= 2 THEN round(a + b * y - abs(b) * (0.5 + off), 6) END AS log_low, CASE WHEN off <= 2 THEN round(a + b * y + abs(b) * (0.5 + off), 6) END AS log_high,
  CASE WHEN off <= 2 THEN 'CANDIDATE' ELSE 'AXIS_NOT_STRAIGHT' END AS status,
  CASE WHEN off <= 2 THEN a + b * y - abs(b) * (0.5 + off) <= log10(1 + abs(value)) AND a + b * y + abs(b) * (0.5 + off) >= log10(1 + abs(value)) END AS holds
FROM m JOIN r USING (user_id)
""")
def marker_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as marks on a logarithmic axis of their user, to whole pixels; for every fifth user one tick stands wrong."""
    events = table(spark, sf_dir, "events").where("value IS NOT NULL")
    size = 1 + F.abs("true")
    marks = events.withColumnRenamed("value", "true").select("event_id", "user_id", "true", F.floor(200.5 - 20 * F.log10(size)).alias("y"), F.lit(0.5).alias("half"))
    tick = events.select("user_id").distinct().select("user_id", span(F.lit(0), F.lit(9)).alias("i"))
    ticks = tick.select("user_id", (20.0 * F.col("i")).alias("pixel"), F.pow(F.lit(10.0), 10 - F.col("i") + F.when((F.col("user_id") % 5 == 0) & (F.col("i") == 3), 2).otherwise(0)).alias("mark"))
    found = ink.marked_values(marks, ink.axis_fits(ticks, ["user_id"], "pixel", "mark", log=True), ["user_id"], "y", "half", log=True)
    holds = (F.log10("low") <= F.log10(size)) & (F.log10("high") >= F.log10(size))
    return found.select("event_id", *[F.round(F.log10(c), 6).alias(f"log_{c}") for c in ("value", "low", "high")], "status", holds.alias("holds"))


@query("""
SELECT s_suppkey AS item, CASE WHEN s_suppkey % 4 < 2 THEN 'REJECT' ELSE 'PASS' END AS verdict, CASE s_suppkey % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'pieces' END AS stage, CASE WHEN s_suppkey % 4 < 2 THEN 'CHANGED' END AS defect
FROM supplier
""")
def replayed_strokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strokes replayed from their pixels: in one of four pictures a pixel has moved since, in another the report of its pieces was changed."""
    from assaylake.operators import pixels, replay

    drawn = bent_lines(spark, sf_dir).select("image", "x", F.col("y").cast("long").alias("y"))
    stages = [("components", lambda df: pixels.components(ink_columns(df))), ("pieces", ink.straight_split), ("slopes", lambda df: df.select("image", "piece", F.round("slope", 6).alias("slope")))]
    claimed = replay.receipt(drawn, stages, "image").withColumn("sha256", F.when((F.col("item") % 4 == 1) & (F.col("stage") == "pieces"), F.lit("0")).otherwise(F.col("sha256")))
    moved = drawn.withColumn("y", F.col("y") + F.when((F.col("image") % 4 == 0) & (F.col("x") == 3), 1).otherwise(0))
    return replay.verify(moved, stages, "image", claimed)


def ink_columns(lines: DataFrame) -> DataFrame:
    """A line's pixels with those between its steps, so that it is one piece."""
    from pyspark.sql import Window

    last = F.coalesce(F.lag("y").over(Window.partitionBy("image").orderBy("x")), F.col("y"))
    return lines.withColumn("_y", last).select("image", "x", F.explode(F.sequence(F.col("y"), F.when(F.col("_y") < F.col("y"), F.col("_y") + 1).when(F.col("_y") > F.col("y"), F.col("_y") - 1).otherwise(F.col("y")))).alias("y"))


@query("""
SELECT l_orderkey AS record, CASE WHEN r % 5 <> 4 THEN r END AS left_order, CASE WHEN r % 7 <> 6 THEN r END AS right_order,
  CASE WHEN r % 5 <> 4 AND r % 7 <> 6 THEN CASE WHEN r % 3 = 0 THEN 'CONTEXT' ELSE 'SCALAR' END END AS tier
FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r % 5 <> 4 OR r % 7 <> 6
""")
def performance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as measured results in two layers: a third agree in their context, a third by value alone, a third by the value before its conversion."""
    from pyspark.sql import Window

    from assaylake.operators import review

    r = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").withColumn("r", r).select(F.col("l_orderkey").alias("record"), "r", (F.col("l_quantity") * 100 + F.col("r")).alias("v"))
    kind = F.col("r") % 3
    left = rows.where("r % 5 != 4").select("record", "r", F.lit("Flexural strength").alias("name"), F.col("v").cast("string").alias("value"), F.lit("MPa").alias("unit"), F.lit("28").alias("age"), F.lit("paste").alias("specimen"), F.lit(None).cast("string").alias("method"))
    right = rows.where("r % 7 != 6").select(
        "record", "r", F.lit("flexural-strength").alias("name"), F.when(kind == 2, F.col("v") * 1000).otherwise(F.col("v")).cast("string").alias("value"), F.when(kind == 2, "kPa").otherwise("mpa").alias("unit"), F.when(kind == 0, "28.0").alias("age"), F.lit("Paste").alias("specimen"),
        F.lit("").alias("method"), F.when(kind == 2, F.col("v").cast("string")).alias("original_value"), F.lit("MPa").alias("original_unit"),
    )
    return review.pair_performance(left, right, "record", "r").drop("error")
