"""Log lines as rows, with the place each line holds in its file.

Spark cuts a text file into splits and reads them in parallel, so no task knows how many lines stand
before its split. The text is read once and written as it comes, with its split and its row there:
``monotonically_increasing_id`` grows by one per line inside a split. The line counts of the splits (one small
row each, from two narrow columns of what was written) add up to the number of lines before a split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logwarden.functions.text import strip
from logwarden.plans.workarea import WorkArea

SPLIT = ["path", "split_start"]


def read_log_lines(spark: SparkSession, paths: str | list[str], work: WorkArea) -> DataFrame:
    """Every physical line of the files, blank ones included: value, path, line_number from 1."""
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_start")]
    lines = spark.read.text(paths).select("value", *place, F.monotonically_increasing_id().alias("split_row"))
    return numbered(work.write(lines, work.fresh("lines")), work)


@contextmanager
def splits_of(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Files that are read meanwhile are cut into splits of at most this size."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def listed_files(spark: SparkSession, source: str, paths: str | list[str]) -> DataFrame:
    """source and path of every input file, those without lines included, as Spark's reader lists them."""
    listed = [(source, re.sub("^file:/+", "file:/", path)) for path in spark.read.text(paths).inputFiles()]
    return spark.createDataFrame(listed, "source string, path string")


def prepare_lines(lines: DataFrame) -> DataFrame:
    """Stripped text and a flag for lines that hold nothing; they stay in, as they count as lines."""
    return lines.withColumn("raw_event", strip(F.col("value"))).withColumn("blank", F.col("raw_event") == "")


def split_offsets(lines: DataFrame) -> DataFrame:
    """One row per split: its first split_row and the number of lines before it in its file."""
    counts = lines.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("lines"), F.min("split_row").alias("first_row"))
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *SPLIT, "first_row", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before")
    )


def numbered(lines: DataFrame, work: WorkArea) -> DataFrame:
    """Written lines (value, path, split_start, split_row) with their line_number; all lines of a file must be there.

    The offsets are written, too: their true size decides whether they are broadcast.
    """
    number = F.col("lines_before") + F.col("split_row") - F.col("first_row") + 1
    offsets = work.write(split_offsets(lines), work.fresh("line-offsets"))
    return lines.join(offsets, SPLIT).select("value", "path", number.alias("line_number"))
