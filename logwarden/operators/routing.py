"""Splitting parsed lines into events and rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.functions.text import quoted
from logwarden.plans.workarea import WorkArea
from logwarden.schema import EVENT_COLUMNS, PARSED_COLUMNS, SOURCE_RANK, stable_id

# A reason that ends like this gets the line number appended.
AT_LINE = " at line "

# What becomes of a line.
EVENT, REJECT, BLANK = "event", "reject", "blank"

# Columns a parser may leave out, with their types.
OPTIONAL = {
    "host_name": T.StringType(),
    "source_ip": T.StringType(),
    "user_name": T.StringType(),
    "resource": T.StringType(),
    "invalid_user": T.BooleanType(),
    "command": T.StringType(),
    "identity_type": T.StringType(),
    "request_parameters": T.VariantType(),
}


def bad_ip(text: Column) -> Column:
    return F.concat(quoted(text), F.lit(" does not appear to be an IPv4 or IPv6 address"))


def parsed_rows(rows: DataFrame, source: str, reject_reason: Column) -> DataFrame:
    """Complete a parser's output to the shared columns.

    Every parsed column passes through an expression that mentions the partition number (never negative). Spark
    doesn't copy or move expressions that are not deterministic, so what stands above works with plain
    fields: a filter, a join key or an inferred constraint doesn't repeat the parser's nested expressions. Each column
    has its own, so one that nobody reads isn't computed. A filter on the source still passes and drops the branch.
    """
    fate = F.when(F.col("blank"), BLANK).when(F.col("reject_reason").isNotNull(), REJECT).otherwise(EVENT)
    extra = {
        "event_id": stable_id(F.lit(source), F.col("path"), F.col("line_number").cast("string"), F.col("raw_event")),
        "reject_reason": reject_reason,
    }
    for name, kind in OPTIONAL.items():
        if name not in rows.columns:
            extra[name] = F.lit(None).cast(kind)
    outside = {"source": F.lit(source), "source_rank": F.lit(SOURCE_RANK[source])}
    inside = [name for name in PARSED_COLUMNS if name not in (*outside, "path", "line_number")]
    opaque = [F.when(F.spark_partition_id() >= 0, F.col(name)).alias(name) for name in inside]
    parsed = rows.withColumns(extra).withColumn("fate", fate).select("path", "line_number", *opaque)
    return parsed.withColumns(outside).select(*PARSED_COLUMNS)


def write_outcomes(parsed: DataFrame, work: WorkArea, name: str = "parsed", columns: list[str] = PARSED_COLUMNS) -> DataFrame:
    """Events, rejected and blank lines of all sources, written in one pass and apart from each other.

    ``accepted`` and ``rejected`` of the result read their own files and columns only. ``columns`` are those that somebody is
    going to read, all unless given; there is a row for every line in any case.
    """
    return work.write(parsed.select(*columns), name, "source", "fate", at_once=len(SOURCE_RANK) * 3)


def union_sources(*parsed: DataFrame) -> DataFrame:
    """All sources in one table; source_rank keeps their order."""
    return reduce(DataFrame.unionByName, parsed)


def accepted(parsed: DataFrame) -> DataFrame:
    """The events, with those of their columns that the table has."""
    return parsed.where(F.col("fate") == EVENT).select(*[name for name in EVENT_COLUMNS if name in parsed.columns])


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejected lines with their physical line number and the reason."""
    reason = F.col("reject_reason")
    at_line = F.when(reason.endswith(AT_LINE), F.concat(reason, F.col("line_number").cast("string")))
    return parsed.where(F.col("fate") == REJECT).select(
        "source", "path", "line_number", at_line.otherwise(reason).alias("reason"), "raw_event", "source_rank"
    )
