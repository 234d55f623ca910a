"""Where a plan's lineage ends: checkpoints and written tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of sessions without a setting, by application.
LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder in the warehouse for a session of one machine (deleted at its end), and an error on a cluster."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or LOCAL.get(context.applicationId)
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = LOCAL[context.applicationId] = f"{spark.conf.get('spark.sql.warehouse.dir')}/_{context.applicationId}"
        where = context._jvm.org.apache.hadoop.fs.Path(named)
        where.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(where)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def own_dir(spark: SparkSession) -> str:
    """The application's own part of the shared folder."""
    return f"{shared_dir(spark)}/assaylake/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Deletes the application's written tables; for the end of a job, when no frame that reads them is left."""
    jvm, path = spark.sparkContext._jvm, own_dir(spark)
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared folder: lost executors re-read files."""
    path = f"{own_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """`df` behind a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unsent(df: DataFrame) -> DataFrame:
    """`df` as a side of joins that is shuffled and never broadcast: the planner takes exploded rows to be as few as the rows of the file they come from."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """`df` by its keys in as many partitions as shuffles have, 16 a core at least, which are not merged: adaptive merging goes by compressed bytes, and a few MB of narrow rows are millions of rows in a task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism), *keys)
