"""Changed pixels, rules and reports are found and attributed."""

from pyspark.sql import functions as F

from assaylake.operators import ink, pixels, replay

STAGES = [("components", pixels.components), ("pieces", ink.straight_split), ("values", lambda df: df.select("image", "piece", F.round("slope", 3).alias("slope")))]


def picture(spark, rows):
    return spark.createDataFrame(rows, "image string, x long, y long")


def test_replay(spark):
    rows = [(name, x, 30 + 2 * x if x < 10 else 50 - x) for name in ("a", "b", "c", "d") for x in range(25)]
    claimed = replay.receipt(picture(spark, rows), STAGES, "image")
    assert claimed.count() == 16
    tell = lambda source, stages=STAGES, c=claimed: {r["item"]: (r["verdict"], r["stage"], r["defect"]) for r in replay.verify(source, stages, "image", c).collect()}
    fine = ("PASS", None, None)
    assert tell(picture(spark, rows[::-1]).repartition(3)) == dict.fromkeys("abcd", fine)
    moved = [(n, x, y + 1 if (n, x) == ("b", 7) else y) for n, x, y in rows]
    assert tell(picture(spark, moved)) == {"a": fine, "b": ("REJECT", "source", "CHANGED"), "c": fine, "d": fine}
    assert tell(picture(spark, rows + [("b", 7, 44)])) == {"a": fine, "b": ("REJECT", "source", "CHANGED"), "c": fine, "d": fine}  # a repeated pixel
    other = [*STAGES[:2], ("values", lambda df: STAGES[2][1](df).withColumn("slope", F.col("slope") + (F.col("image") == "c").cast("int")))]
    assert tell(picture(spark, rows), other)["c"] == ("REJECT", "values", "CHANGED")
    report = claimed.withColumn("sha256", F.when((F.col("item") == "d") & (F.col("stage") != "source"), "0").otherwise(F.col("sha256")))
    assert tell(picture(spark, rows), c=report) == {"a": fine, "b": fine, "c": fine, "d": ("REJECT", "components", "CHANGED")}
    less = picture(spark, [r for r in rows if r[0] != "a"] + [("e", 1, 1)])
    assert tell(less) == {"a": ("REJECT", "source", "MISSING"), "b": fine, "c": fine, "d": fine, "e": ("REJECT", "source", "NEW")}
    assert replay.receipt(picture(spark, rows).limit(0), STAGES, "image").count() == 0
