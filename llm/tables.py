"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the session's spark.checkpoint.dir.

    Only where that is unset on a single machine, as in tests, a temporary folder is set first.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str, *by: str) -> DataFrame:
    """`df` written as Parquet to the shared folder, in a new table each time, and read again.

    This cuts the lineage: a lost executor costs tasks of the running stage, not what has been written. `by` names
    columns to split the files by.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes this application's staged tables; frames that still read them can't be computed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
