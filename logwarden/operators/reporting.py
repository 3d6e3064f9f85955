"""Counts and display rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions.scoring import SEVERITIES
from logwarden.functions.text import blank_to_null, iso_text
from logwarden.operators.ecs import principal
from logwarden.operators.routing import EVENT, REJECT
from logwarden.schema import SOURCE_LABEL

# Texts for missing values in reports. Fixed values.
NOT_AVAILABLE = "Not available"
NO_TECHNIQUE = "Operational finding"


def source_label(source: Column) -> Column:
    labels = F.create_map(*[F.lit(text) for pair in SOURCE_LABEL.items() for text in pair])
    return F.coalesce(F.try_element_at(labels, source), source)


def base_name(path: Column) -> Column:
    """The file name alone, whichever way the slashes lean."""
    return F.regexp_extract(path, r"[^/\\]*\z", 0)


def source_summary(parsed: DataFrame, by_path: bool = True, files: DataFrame | None = None) -> DataFrame:
    """Parsed and rejected lines per source, and per file unless ``by_path`` is off; no source is left out.

    With ``files`` (source, path) there is a row for each of them, for those without lines too.
    """
    spark = parsed.sparkSession
    sources = spark.createDataFrame(
        [(rank, source, label) for rank, (source, label) in enumerate(SOURCE_LABEL.items())],
        "source_rank int, source string, name string",
    )
    keys = ["source", "path"] if by_path else ["source"]
    counts = parsed.groupBy(*keys).agg(
        F.count_if(F.col("fate") == EVENT).alias("parsed_events"),
        F.count_if(F.col("fate") == REJECT).alias("rejected_events"),
    )
    if files is not None and by_path:
        counts = files.join(counts, keys, "left")
    # The source list has three rows; counts have one row per file at most.
    shown = ["path"] if by_path else []
    return sources.join(counts, "source", "left").select(
        "source_rank",
        "source",
        "name",
        *shown,
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("parsed_events", "rejected_events")],
    )


def run_summary(parsed: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: how many events, rejected lines and alerts."""
    lines = parsed.agg(
        F.count_if(F.col("fate") == EVENT).alias("events_analyzed"),
        F.count_if(F.col("fate") == REJECT).alias("events_rejected"),
    )
    # One row each: joining them is no product of tables.
    one = F.lit(1).alias("one")
    counted = alerts.agg(F.count(F.lit(1)).alias("alerts_generated")).select("*", one)
    return lines.select("*", one).join(counted, "one").drop("one")


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per severity; all five levels are shown."""
    levels = alerts.sparkSession.createDataFrame(
        [(rank, name) for rank, name in enumerate(SEVERITIES)], "level int, severity string"
    )
    counts = alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))
    return levels.join(counts, "severity", "left").select(
        "level", "severity", F.coalesce("alerts", F.lit(0)).cast("bigint").alias("alerts")
    )


def alert_source_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("source").agg(F.count(F.lit(1)).alias("alerts"))


def run_report(parsed: DataFrame, alerts: DataFrame) -> DataFrame:
    """All counts of a run by one aggregation over its lines and alerts.

    section, source, path, severity, events, rejects and alerts; the sections are `file` (lines of each file), `source`
    (lines and alerts of each), `severity` (alerts of each) and `run` (one row). All sources and severities are there.
    """
    spark = parsed.sparkSession
    none, zero, one = F.lit(None).cast("string"), F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    count = lambda fate: F.when(F.col("fate") == fate, one).otherwise(zero)
    lines = parsed.select("source", "path", none.alias("severity"), count(EVENT).alias("events"), count(REJECT).alias("rejects"), zero.alias("alerts"))
    found = alerts.select("source", none.alias("path"), "severity", zero.alias("events"), zero.alias("rejects"), one.alias("alerts"))
    known = [(name, None, None, 0, 0, 0) for name in SOURCE_LABEL] + [(None, None, name, 0, 0, 0) for name in SEVERITIES]
    facts = lines.unionByName(found).unionByName(spark.createDataFrame(known, lines.schema))
    sums = facts.groupingSets([["source", "path"], ["source"], ["severity"], []], "source", "path", "severity").agg(
        F.grouping_id().alias("left_out"), *[F.sum(name).alias(name) for name in ("events", "rejects", "alerts")]
    )
    # bits of what a set leaves out: source 4, path 2, severity 1; the fact rows of other sections have nulls there
    section = (
        F.when((F.col("left_out") == 1) & F.col("path").isNotNull(), "file")
        .when((F.col("left_out") == 3) & F.col("source").isNotNull(), "source")
        .when((F.col("left_out") == 6) & F.col("severity").isNotNull(), "severity")
        .when(F.col("left_out") == 7, "run")
    )
    return sums.select(section.alias("section"), "source", "path", "severity", "events", "rejects", "alerts").where("section is not null")


# Columns of the flat alert list, in order. Fixed values.
CSV_COLUMNS = [
    "alert_id",
    "detected_at",
    "rule_id",
    "title",
    "severity",
    "risk_score",
    "source",
    "source_ip",
    "user_name",
    "resource",
    "mitre_techniques",
    "evidence",
    "recommended_action",
    "false_positive_notes",
]


def csv_rows(alerts: DataFrame) -> DataFrame:
    """The flat alert list: lists joined, missing values empty."""
    shown = {
        "detected_at": iso_text(F.col("detected_at"), "+00:00"),
        "mitre_techniques": F.array_join("mitre_techniques", "; "),
        "evidence": F.array_join("evidence", " | "),
        "false_positive_notes": F.array_join("false_positive_notes", " | "),
    }
    for name in ("source_ip", "user_name", "resource"):
        shown[name] = F.coalesce(name, F.lit(""))
    return alerts.select(*[shown.get(name, F.col(name)).alias(name) for name in CSV_COLUMNS])


def report_rows(alerts: DataFrame) -> DataFrame:
    """What a report shows of each alert."""
    available = lambda name: F.coalesce(blank_to_null(F.col(name)), F.lit(NOT_AVAILABLE)).alias(name)
    techniques = blank_to_null(F.array_join("mitre_techniques", ", "))
    return alerts.select(
        "alert_id",
        "title",
        "rule_id",
        "severity",
        "risk_score",
        "description",
        source_label(F.col("source")).alias("source"),
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("detected"),
        available("source_ip"),
        available("user_name"),
        available("resource"),
        F.coalesce(techniques, F.lit(NO_TECHNIQUE)).alias("techniques"),
        "evidence",
        "recommended_action",
        "false_positive_notes",
    )


def report_sources(summary: DataFrame) -> DataFrame:
    """Source statistics with file names only."""
    return summary.withColumn("path", base_name(F.col("path")))


def principals(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id",
        "rule_id",
        "severity",
        "risk_score",
        principal(F.col("user_name"), F.col("source_ip")).alias("principal"),
    )


def run_metadata(spark: SparkSession, started_at, completed_at) -> DataFrame:
    """Start, end and duration of a run, from the driver's clock."""
    seconds = round((completed_at - started_at).total_seconds(), 4)
    return spark.createDataFrame(
        [(started_at.isoformat(), completed_at.isoformat(), seconds, round(seconds * 1000, 2))],
        "started_at string, completed_at string, duration_seconds double, duration_milliseconds double",
    )
