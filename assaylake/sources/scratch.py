"""Shared scratch space for intermediate tables that must survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Where none is set a local master gets a temporary folder; on a cluster that would lose
    rows, as every executor would write to its own disk, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="assaylake-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own part of the folder."""
    return f"{checkpoint_dir(spark)}/assaylake-{spark.sparkContext.applicationId}"


def written_table(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: Spark then knows its real size,
    and decides about a broadcast from it."""
    path = f"{scratch_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that this application has written; to be called when their readers are done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
