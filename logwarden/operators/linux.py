"""Linux authentication log: SSH logins and sudo commands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import with_canonical_ip
from logwarden.functions.text import NOT_WS, WS, blank_to_null, match_groups, matched, search_groups, strip
from logwarden.functions.times import syslog_timestamp
from logwarden.operators.routing import AT_LINE, bad_ip, parsed_rows
from logwarden.schema import LINUX
from logwarden.sources.lines import prepare_lines

# Formats of the log. Fixed values.
HEADER = (
    rf"(?dU)^([A-Z][a-z]{{2}}){WS}+(\d{{1,2}}){WS}+(\d{{2}}:\d{{2}}:\d{{2}}){WS}+({NOT_WS}+){WS}+"
    rf"([A-Za-z0-9_.-]+)(?:\[(\d+)\])?:{WS}+(.+)$"
)
FAILED = rf"Failed password for (invalid user{WS}+)?({NOT_WS}+){WS}+from{WS}+({NOT_WS}+){WS}+port{WS}+(\d+)"
ACCEPTED = rf"Accepted {NOT_WS}+ for ({NOT_WS}+){WS}+from{WS}+({NOT_WS}+){WS}+port{WS}+(\d+)"
SUDO = (
    rf"({NOT_WS}+){WS}*:{WS}*TTY=([^;]+){WS}*;{WS}*PWD=([^;]+){WS}*;{WS}*USER=([^;]+){WS}*;{WS}*COMMAND=(.+)"
)

UNSUPPORTED_FORMAT = "Unsupported Linux auth format" + AT_LINE
INVALID_TIMESTAMP = "Invalid Linux auth timestamp"
UNSUPPORTED_EVENT = "Unsupported Linux authentication event" + AT_LINE


def parse_linux(lines: DataFrame, year: int = 2026) -> DataFrame:
    """One row per line: a normalized event, or the reason why there is none."""
    header = lambda i: F.get("header", F.lit(i))
    group = lambda i: F.get("parts", F.lit(i))
    kind = F.col("kind")

    rows = (
        prepare_lines(lines)
        .withColumn("header", match_groups(F.col("raw_event"), HEADER, 7))
        .withColumns(
            {
                "timestamp": syslog_timestamp(year, header(1), header(2), header(3)),
                "host_name": header(4),
                "process": header(5),
                "pid": blank_to_null(header(6)),
                "message": header(7),
            }
        )
        .withColumn("failed", search_groups(F.col("message"), FAILED, 4))
        .withColumn("accepted", F.when(~matched(F.col("failed")), search_groups(F.col("message"), ACCEPTED, 3)))
        .withColumn(
            "sudo",
            F.when(
                ~matched(F.col("failed")) & ~matched(F.col("accepted")), search_groups(F.col("message"), SUDO, 5)
            ),
        )
        # The first form that matches decides; "parts" holds its groups.
        .withColumn(
            "kind",
            F.when(matched(F.col("failed")), "failed")
            .when(matched(F.col("accepted")), "accepted")
            .when(matched(F.col("sudo")), "sudo"),
        )
        .withColumn(
            "parts",
            F.when(kind == "failed", F.col("failed"))
            .when(kind == "accepted", F.col("accepted"))
            .when(kind == "sudo", F.col("sudo")),
        )
        .withColumns(
            {
                "user_name": F.when(kind == "failed", group(2)).otherwise(group(1)),
                "invalid_user": F.when(kind == "failed", group(1) != ""),
                "command": F.when(kind == "sudo", strip(group(5))),
                "ip_text": F.when(kind == "failed", group(3)).when(kind == "accepted", group(2)),
                "port": F.when(kind == "failed", group(4)).when(kind == "accepted", group(3)).try_cast("bigint"),
            }
        )
        .transform(with_canonical_ip, "ip_text", "source_ip")
    )

    process = F.col("process")
    attributes = (
        F.when(
            kind == "failed",
            F.to_variant_object(
                F.struct(process, F.col("pid"), F.col("port").alias("source_port"), F.col("invalid_user"))
            ),
        )
        .when(
            kind == "accepted",
            F.to_variant_object(F.struct(process, F.col("pid"), F.col("port").alias("source_port"))),
        )
        .when(
            kind == "sudo",
            F.to_variant_object(
                F.struct(
                    process,
                    strip(group(4)).alias("target_user"),
                    strip(group(3)).alias("working_directory"),
                    strip(group(2)).alias("tty"),
                    F.col("command"),
                )
            ),
        )
    )
    sudo = kind == "sudo"
    reject_reason = (
        F.when(~matched(F.col("header")), UNSUPPORTED_FORMAT)
        .when(F.col("timestamp").isNull(), INVALID_TIMESTAMP)
        .when(kind.isNull(), UNSUPPORTED_EVENT)
        .when(~sudo & F.col("source_ip").isNull(), bad_ip(F.col("ip_text")))
    )
    return parsed_rows(
        rows.withColumns(
            {
                "category": F.when(sudo, F.array(F.lit("process"), F.lit("configuration"))).otherwise(
                    F.array(F.lit("authentication"))
                ),
                "event_type": F.array(F.lit("start")),
                "outcome": F.when(kind == "failed", "failure").otherwise("success"),
                "action": F.when(kind == "failed", "ssh_login_failed")
                .when(kind == "accepted", "ssh_login_success")
                .when(sudo, "sudo_command"),
                "resource": F.col("command"),
                "attributes": attributes,
            }
        ),
        LINUX,
        reject_reason,
    )
