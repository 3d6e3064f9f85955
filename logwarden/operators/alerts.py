"""All rules together, and the order of their alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.catalog import complete_alerts
from logwarden.operators.correlate import CORRELATIONS, FINDING_COLUMNS, correlated_findings
from logwarden.operators.numbering import numbered
from logwarden.operators.rules import direct_findings
from logwarden.plans.workarea import WorkArea
from logwarden.schema import POSITION
from logwarden.settings import DetectionSettings


def detect(
    events: DataFrame,
    settings: DetectionSettings,
    work: WorkArea,
    rules: set[str] | None = None,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Alerts of every rule, or of those in ``rules``, in no particular order; ``limits`` as in ``operators.limits``."""
    findings = correlated_findings(events, settings, work, rules, limits)
    grouped = {name for names in CORRELATIONS for name in names}
    if rules is None or rules - grouped:
        direct = direct_findings(events, settings).select(*FINDING_COLUMNS)
        findings.insert(0, direct if rules is None else direct.where(F.col("rule_id").isin(*sorted(rules - grouped))))
    return complete_alerts(reduce(DataFrame.unionByName, findings))


#: Highest score first, then latest; equal ones in the order in which the input gave rise to them. No two rules share a
#: score, so such ties only occur within one rule.
ALERT_ORDER = (("risk_score", False), ("detected_at", False), ("seen", True), ("alert_id", True))


def alert_order() -> list[Column]:
    return [F.asc(name) if rising else F.desc(name) for name, rising in ALERT_ORDER]


def rank_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts in the order above."""
    return alerts.orderBy(*alert_order())


def ranked_alerts(alerts: DataFrame, work: WorkArea) -> DataFrame:
    """Alerts with their ``rank`` from 1 in the order above; as rows, whose own order doesn't matter."""
    return numbered(alerts, alert_order(), work, "ranked", "rank")


def events_in_input_order(events: DataFrame) -> DataFrame:
    """Events dealt by ranges of their place and sorted within: the part files follow the input's order."""
    return events.repartitionByRange(*POSITION).sortWithinPartitions(*POSITION)
