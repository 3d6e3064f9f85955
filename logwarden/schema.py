"""Column names shared by the parsers, the rules and the sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CISCO = "cisco_ios"
LINUX = "linux_auth"
CLOUDTRAIL = "aws_cloudtrail"

# Input order of the sources, and their display names. Fixed values.
SOURCE_RANK = {CISCO: 0, LINUX: 1, CLOUDTRAIL: 2}
SOURCE_LABEL = {
    CISCO: "Cisco IOS Syslog",
    LINUX: "Linux Authentication",
    CLOUDTRAIL: "AWS CloudTrail",
}

# Where a line stands in the input.
POSITION = ["source_rank", "path", "line_number"]

# Columns of a normalized event that the reference model has, in its order.
EVENT_FIELDS = [
    "event_id",
    "timestamp",
    "source",
    "category",
    "event_type",
    "outcome",
    "action",
    "message",
    "host_name",
    "source_ip",
    "user_name",
    "resource",
    "raw_event",
    "attributes",
]

# Typed copies of the attributes that rules look at.
RULE_FIELDS = ["invalid_user", "command", "identity_type", "request_parameters"]

EVENT_COLUMNS = EVENT_FIELDS + RULE_FIELDS + POSITION

PARSED_COLUMNS = EVENT_COLUMNS + ["blank", "reject_reason", "fate"]

# What finding alerts and their events reads of the lines, and what tells events from other lines. The text of a line, its
# attributes and its classes only show in events, documents and reports.
DETECTION_COLUMNS = [
    name for name in PARSED_COLUMNS if name not in ("category", "event_type", "raw_event", "attributes", "blank", "reject_reason")
]

ALERT_FIELDS = [
    "alert_id",
    "rule_id",
    "title",
    "description",
    "detected_at",
    "severity",
    "risk_score",
    "source",
    "source_ip",
    "user_name",
    "resource",
    "mitre_techniques",
    "event_ids",
    "evidence",
    "recommended_action",
    "false_positive_notes",
]

# What an alert carries besides: how many events it covers, their time range and host, the one event it
# is about if there is one, and its place among alerts of the same score and time.
ALERT_EXTRAS = ["event_count", "first_event_at", "last_event_at", "host_name", "own_event_id", "seen"]

# The table of alerts. The events of an alert are rows of their own (operators.members); only documents
# list them.
ALERT_COLUMNS = [name for name in ALERT_FIELDS if name != "event_ids"] + ALERT_EXTRAS


def position() -> Column:
    return F.struct(*POSITION)


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped text that depends on nothing but its inputs, so recomputing it gives the same."""
    digest = F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 32)
    for place in (9, 14, 19, 24):
        digest = F.overlay(digest, F.lit("-"), place, 0)
    return digest
