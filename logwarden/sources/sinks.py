"""Writers for reports and search-index documents. Every output is a folder of part files.

Neighbouring alerts list almost the same events, so that documents repeat each other at distances of a whole list. ``ZSTD`` as the
``compression`` of a writer takes that out; ``packed`` reads such files.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F

from logwarden.operators.alerts import events_in_input_order, rank_alerts
from logwarden.operators.ecs import alert_text, event_record, to_alert_documents, to_ecs, to_json_with_nulls
from logwarden.operators.reporting import csv_rows
from logwarden.plans.workarea import FOLDERS_AT_ONCE
from logwarden.session import setting

#: Standard zstd streams, in files that end in .zstd; of the codecs that come with Spark this one sees far enough back and needs no native Hadoop.
ZSTD = "org.apache.parquet.hadoop.codec.ZstandardCodec"


def packed(spark: SparkSession) -> DataFrameReader:
    """A reader for text and JSON files, those written with ``ZSTD`` included."""
    return spark.read.option("io.compression.codecs", ZSTD)


def index_prefix(text: Column) -> Column:
    """An index name's beginning: a-z, 0-9, _ and - stay, anything else becomes dashes; none left is an error."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9_-]+", "-")
    left = F.nullif(F.regexp_replace(dashed, r"^[-_]+|[-_]+\z", ""), F.lit(""))
    return F.coalesce(left, F.raise_error(F.lit("index prefix cannot be empty")).cast("string"))


def index_name(prefix: str, kind: str, day: date | datetime) -> Column:
    """Name of the index of events or alerts of a run that started on a day."""
    return F.concat(index_prefix(F.lit(prefix)), F.lit(f"-{kind}-{day:%Y.%m.%d}"))


def index_names(spark: SparkSession, prefix: str, day: date | datetime) -> list[str]:
    """The two indexes of a run, of events and of alerts."""
    return list(spark.range(1).select(index_name(prefix, "events", day), index_name(prefix, "alerts", day)).first())


def index_documents(events: DataFrame, alerts: DataFrame, prefix: str, day: date | datetime) -> DataFrame:
    """All documents with the index each belongs to; the alerts have their ``event_ids``."""
    return (
        to_ecs(events)
        .select(index_name(prefix, "events", day).alias("_index"), "document")
        .unionByName(to_alert_documents(alerts).select(index_name(prefix, "alerts", day).alias("_index"), "document"))
    )


def index_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("_index").agg(F.count(F.lit(1)).alias("documents"))


def write_bulk(documents: DataFrame, path: str, *indexes: str, compression: str = "none") -> dict[str, int]:
    """Bulk-load files, an action line and a document line per document, in one folder per index.

    Returns how many documents were written for each of the named indexes, counted as they were written. A task writes to the
    folders of all of these at a time, so that documents aren't sorted by their index first.
    """
    action = F.to_json(F.struct(F.struct(F.col("_index")).alias("index")))
    written = Observation()
    counts = [F.count_if(F.col("_index") == name).alias(f"index {i}") for i, name in enumerate(indexes)]
    lines = documents.select("_index", F.concat(action, F.lit("\n"), F.col("document")).alias("value"))
    observed = lines.observe(written, F.count(F.lit(1)).alias("all"), *counts)
    with setting(documents.sparkSession, FOLDERS_AT_ONCE, str(len(indexes))):
        observed.write.partitionBy("_index").text(path, compression=compression)
    return {name: written.get[f"index {i}"] for i, name in enumerate(indexes)}


def _csv_line(cells: list[Column]) -> Column:
    """Cells with commas between them; one with a comma, a quote or a line break stands in quotes, its quotes doubled."""
    quoted = lambda cell: F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
    shown = [F.coalesce(cell.cast("string"), F.lit("")) for cell in cells]
    return F.concat_ws(",", *[F.when(cell.rlike('[",\\r\\n]'), quoted(cell)).otherwise(cell) for cell in shown])


def write_csv(alerts: DataFrame, path: str) -> None:
    """The flat alert list in rank order, quoted only where needed; each part file begins with the header.

    The lines are put together here, as Spark's CSV writer turns the line breaks inside cells into the one between rows.
    """
    rows = csv_rows(rank_alerts(alerts))
    line = _csv_line([F.col(name) for name in rows.columns])
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # the row's number in its part
    header = F.lit(",".join(rows.columns) + "\r\n")
    rows.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.option("lineSep", "\r\n").text(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_csv`` wrote, as text; cells may hold quotes and line breaks."""
    return spark.read.options(header=True, multiLine=True, escape='"', lineSep="\r\n").csv(path)


def write_json_report(result, path: str, compression: str = "none") -> None:
    """One dataset per section of the report."""

    def records(table: DataFrame, record: Column, name: str) -> None:
        table.select(record.alias("value")).write.text(f"{path}/{name}", compression=compression)

    def whole(table: DataFrame, name: str) -> None:
        table.write.option("ignoreNullFields", "false").json(f"{path}/{name}", compression=compression)

    records(result.ranked_documents, alert_text(), "alerts")
    records(events_in_input_order(result.events), to_json_with_nulls(event_record()), "events")
    rejects = result.rejects.orderBy("source_rank", "path", "line_number")
    whole(rejects.select("source", "path", "line_number", "reason", "raw_event"), "rejected_events")
    whole(result.sources.orderBy("source_rank", "path").drop("source_rank", "source"), "sources")
    whole(result.run_summary, "summary")
    whole(result.metadata(), "metadata")
