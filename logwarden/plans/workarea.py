"""Written intermediate tables.

A table written once cuts the lineage, survives lost executors, and gives the optimizer the true size
of a small result, so that it broadcasts it or not by its own threshold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from logwarden.session import setting, shared_folder

# Folders that a task writes to at a time; without them it sorts its rows, lines of text and all, by their folder first.
FOLDERS_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"
# Whether a VARIANT is taken apart into columns of its own as it is written, which costs more than reading them saves here.
SHREDDING = "spark.sql.variant.inferShreddingSchema"


class WorkArea:
    """A folder of its own, for one run, inside the shared folder of the cluster."""

    def __init__(self, spark: SparkSession, name: str = "run") -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark)}/logwarden-{name}-{uuid.uuid4().hex}"

    def write(self, table: DataFrame, name: str, *partition_by: str, at_once: int = 0) -> DataFrame:
        """``at_once`` is the number of folders that a task keeps open, if it is known to meet few; 0 sorts its rows."""
        path = f"{self.path}/{name}"
        writer = table.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with setting(self.spark, FOLDERS_AT_ONCE, str(at_once)), setting(self.spark, SHREDDING, "false"):
            writer.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def fresh(self, name: str) -> str:
        """A name that no table of the area has yet."""
        return f"{name}-{uuid.uuid4().hex[:12]}"

    def clear(self) -> None:
        """Remove the area; tables that read it can't be computed any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
