"""From log files to alerts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from logwarden.operators.alerts import alert_order, detect
from logwarden.operators.cisco import parse_cisco
from logwarden.operators.cloudtrail import parse_cloudtrail
from logwarden.operators.linux import parse_linux
from logwarden.operators.members import alert_members, listed_events, listed_in_order
from logwarden.operators.reporting import run_metadata, run_summary, source_summary
from logwarden.operators.routing import accepted, rejected, union_sources, write_outcomes
from logwarden.plans.workarea import WorkArea
from logwarden.schema import CISCO, CLOUDTRAIL, LINUX
from logwarden.session import prepare_session
from logwarden.settings import DetectionSettings
from logwarden.sources.lines import listed_files, read_log_lines


@dataclass(frozen=True)
class AnalysisResult:
    """The tables of one run. ``alerts`` is unordered; see ``operators.alerts.rank_alerts``."""

    started_at: datetime
    completed_at: datetime
    settings: DetectionSettings
    parsed: DataFrame
    alerts: DataFrame
    work: WorkArea
    files: DataFrame
    limits: DataFrame | None = None

    @property
    def events(self) -> DataFrame:
        return accepted(self.parsed)

    @property
    def rejects(self) -> DataFrame:
        return rejected(self.parsed)

    @property
    def sources(self) -> DataFrame:
        return source_summary(self.parsed, files=self.files)

    @property
    def run_summary(self) -> DataFrame:
        return run_summary(self.parsed, self.alerts)

    def members(self) -> DataFrame:
        """The events of all alerts, as rows."""
        return alert_members(self.events, self.alerts, self.settings, self.limits)

    @property
    def documents(self) -> DataFrame:
        """Alerts with the list of their events; an alert over very many has several rows, each with a part of them."""
        return listed_events(self.alerts, self.events, self.settings, self.work, self.limits)

    @property
    def ranked_documents(self) -> DataFrame:
        """The same in the alerts' order, in ranges of it."""
        return listed_in_order(self.alerts, self.events, self.settings, self.work, alert_order(), self.limits)

    def metadata(self) -> DataFrame:
        return run_metadata(self.parsed.sparkSession, self.started_at, self.completed_at)


def analyze(
    spark: SparkSession,
    cisco: str | list[str],
    linux: str | list[str],
    cloudtrail: str | list[str],
    settings: DetectionSettings | None = None,
    year: int = 2026,
    limits: DataFrame | None = None,
) -> AnalysisResult:
    """Parse all sources and run every rule; ``limits`` gives single addresses or hosts limits of their own.

    The parsed lines, the numbers of groups and the alerts are written to a work area in the cluster's
    shared folder (``spark.checkpoint.dir``): the text is read and parsed once, every rule reads only its
    columns and its source's files, plans stay small, and a lost executor costs no more than its tasks.
    ``work.clear()`` of the result removes the area.
    """
    prepare_session(spark)
    started = datetime.now(UTC)
    settings = settings or DetectionSettings()
    work = WorkArea(spark)
    parsed = union_sources(
        parse_cisco(read_log_lines(spark, cisco, work), year),
        parse_linux(read_log_lines(spark, linux, work), year),
        parse_cloudtrail(read_log_lines(spark, cloudtrail, work)),
    )
    parsed = write_outcomes(parsed, work)
    given = {CISCO: cisco, LINUX: linux, CLOUDTRAIL: cloudtrail}
    files = union_sources(*[listed_files(spark, source, paths) for source, paths in given.items()])
    alerts = work.write(detect(accepted(parsed), settings, work, limits=limits), "alerts")
    return AnalysisResult(started, datetime.now(UTC), settings, parsed, alerts, work, files, limits)
