"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder: plans of loops stay short, and a lost executor costs one read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, whose files go when the driver's JVM ends."""
    name = f"{shared_dir(spark)}/strandline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def stored(df: DataFrame) -> DataFrame:
    """As cut_lineage(), as Parquet of which later plans read only the columns they need."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed(df: DataFrame) -> DataFrame:
    """df, the smaller side of a join, to be hashed where it is too large to be broadcast: a sort-merge join would sort both
    sides, and a task's memory would grow with the larger one."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df if _estimated(df) <= most else df.hint("shuffle_hash")


def dealt(df: DataFrame, *by: str, mb: int = 2) -> DataFrame:
    """df by `by` over as many partitions as it has `mb` MB by Spark's estimate, so that what a task sorts does not grow with
    the input. Small tables are left to Spark: below that size one task is enough."""
    n = _estimated(df) // (mb << 20)
    return df.repartition(n, *by) if n > 1 else df


def _estimated(df: DataFrame) -> int:
    """Bytes of df, as the planner takes them from files and columns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it. Only a local master may do without one.
    Checkpoints in it go when the driver's JVM ends."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if held.isEmpty():
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandline-"))
        held = sc._jsc.sc().getCheckpointDir()
        path = spark._jvm.org.apache.hadoop.fs.Path(held.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return named or held.get()
