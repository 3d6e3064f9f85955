"""Cisco IOS syslog: logins, configuration changes, interface state changes, everything else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import with_canonical_ip
from logwarden.functions.text import NOT_WS, WS, match_groups, matched, search_groups, strip
from logwarden.functions.times import syslog_timestamp
from logwarden.operators.routing import AT_LINE, bad_ip, parsed_rows
from logwarden.schema import CISCO
from logwarden.sources.lines import prepare_lines

# Formats of the log. Fixed values. WORD is what a Unicode-aware \w of the log's tooling accepts.
WORD = r"[\p{L}\p{N}_]"
HEADER = (
    rf"(?dU)^([A-Z][a-z]{{2}}){WS}+(\d{{1,2}}){WS}+(\d{{2}}:\d{{2}}:\d{{2}}){WS}+({NOT_WS}+){WS}+"
    rf"%([A-Z0-9_]+)-(\d)-([A-Z0-9_]+):{WS}*(.+)$"
)
USER = rf"\[user:{WS}*([^\]]+)\]"
SOURCE = rf"\[Source:{WS}*([^\]]+)\]"
CONFIG_USER = rf"(?<!{WORD})by{WS}+([A-Za-z0-9_.-]+)"
PARENTHESIZED_IP = r"\((\d{1,3}(?:\.\d{1,3}){3})\)"
INTERFACE = rf"Interface{WS}+([^,]+),{WS}+changed state to{WS}+({WORD}+)"

UNSUPPORTED_FORMAT = "Unsupported Cisco IOS syslog format" + AT_LINE
INVALID_TIMESTAMP = "Invalid Cisco IOS timestamp"


def parse_cisco(lines: DataFrame, year: int = 2026) -> DataFrame:
    """One row per line: a normalized event, or the reason why there is none."""
    header = lambda i: F.get("header", F.lit(i))
    found = lambda groups, i=1: F.when(matched(F.col(groups)), F.get(groups, F.lit(i)))
    message, mnemonic = F.col("message"), F.col("mnemonic")
    login = mnemonic.isin("LOGIN_FAILED", "LOGIN_SUCCESS")
    config, updown = mnemonic == "CONFIG_I", mnemonic == "UPDOWN"

    rows = (
        prepare_lines(lines)
        .withColumn("header", match_groups(F.col("raw_event"), HEADER, 8))
        .withColumns(
            {
                "timestamp": syslog_timestamp(year, header(1), header(2), header(3)),
                "host_name": header(4),
                "facility": header(5),
                "severity_code": header(6).try_cast("int"),
                "mnemonic": header(7),
                "message": header(8),
            }
        )
        .withColumns(
            {
                "user_groups": F.when(message.contains("["), search_groups(message, USER, 1)),
                "source_groups": F.when(message.contains("["), search_groups(message, SOURCE, 1)),
                "by_groups": F.when(config, search_groups(message, CONFIG_USER, 1)),
                "paren_groups": F.when(config, search_groups(message, PARENTHESIZED_IP, 1, flags="dU")),
                "interface": F.when(updown, search_groups(message, INTERFACE, 2)),
            }
        )
        .withColumns(
            {
                # A configuration change names its user and address in its own way, which wins.
                "ip_text": F.coalesce(found("paren_groups"), strip(found("source_groups"))),
                "user_name": F.coalesce(found("by_groups"), strip(found("user_groups"))),
                "resource": found("interface", 1),
                "state": F.lower(found("interface", 2)),
            }
        )
        .transform(with_canonical_ip, "ip_text", "source_ip")
    )
    outcome = (
        F.when(mnemonic == "LOGIN_FAILED", "failure")
        .when(mnemonic == "LOGIN_SUCCESS", "success")
        .when(config, "success")
        .when(F.col("state") == "up", "success")
        .when(F.col("state").isNotNull(), "failure")
        .otherwise("unknown")
    )
    reject_reason = (
        F.when(~matched(F.col("header")), UNSUPPORTED_FORMAT)
        .when(F.col("timestamp").isNull(), INVALID_TIMESTAMP)
        .when(
            matched(F.col("paren_groups")) & F.col("source_ip").isNull(), bad_ip(found("paren_groups"))
        )
    )
    return parsed_rows(
        rows.withColumns(
            {
                "category": F.array(
                    F.when(login, "authentication").when(config, "configuration").otherwise("network")
                ),
                "event_type": F.array(F.when(login, "start").when(config | updown, "change").otherwise("info")),
                "outcome": outcome,
                "action": F.when(config, "cisco_configuration_change")
                .when(updown, "cisco_interface_state_change")
                .otherwise(F.concat(F.lit("cisco_"), F.lower(mnemonic))),
                "attributes": F.to_variant_object(F.struct("facility", "severity_code", "mnemonic")),
            }
        ),
        CISCO,
        reject_reason,
    )
