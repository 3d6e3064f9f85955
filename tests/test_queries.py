"""Queries against their SQL on the smallest tables, and the golden log's parsers on odd lines."""

import duckdb
import pytest

from logwarden.functions.scoring import severity_from_score
from logwarden.operators.cisco import parse_cisco
from logwarden.operators.cloudtrail import parse_cloudtrail
from logwarden.operators.linux import parse_linux
from logwarden.operators.routing import accepted, rejected
from logwarden.queries import ORACLE_SQL, QUERIES
from samples import CISCO_LOG, CLOUDTRAIL_LOG, LINUX_LOG

SF_DIR = "/root/testdata/sf0.001"


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", ["linux_failed_logins", "linux_rejects", "cisco_events", "ct_events", "corr_user_enum", "ranked_alerts", "source_summary", "alert_docs", "index_counts", "log_line_numbers", "run_report", "csv_file_rows", "json_report_rows", "invalid_addresses", "rule_public_port"])
def test_query_equals_its_sql(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    found = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    want = [tuple(map(plain, r)) for r in found.fetchall()]
    assert sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=str) == sorted(want, key=str) and want


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize(
    ("parse", "log", "bad", "reason"),
    [
        (parse_linux, LINUX_LOG, "not a supported auth event", "Unsupported Linux auth format at line 1"),
        (parse_linux, LINUX_LOG, "Feb 30 10:00:00 h sshd[1]: Accepted password for a from 1.2.3.4 port 1 ssh2", "Invalid Linux auth timestamp"),
        (parse_linux, LINUX_LOG, "Jul 27 10:00:00 h sshd[1]: Failed password for a from 1.2.3.400 port 1 ssh2", "'1.2.3.400' does not appear to be an IPv4 or IPv6 address"),
        (parse_linux, LINUX_LOG, "Jul 27 10:00:00 h sshd[1]: Connection closed", "Unsupported Linux authentication event at line 1"),
        (parse_cisco, CISCO_LOG, "invalid Cisco log record", "Unsupported Cisco IOS syslog format at line 1"),
        (parse_cloudtrail, CLOUDTRAIL_LOG, "{invalid json}", "Invalid CloudTrail JSON at line 1"),
        (parse_cloudtrail, CLOUDTRAIL_LOG, "[1]", "CloudTrail record must be an object at line 1"),
        (parse_cloudtrail, CLOUDTRAIL_LOG, '{"eventTime": "", "eventName": "x", "eventSource": "y"}', "CloudTrail record missing required fields at line 1"),
        (parse_cloudtrail, CLOUDTRAIL_LOG, '{"eventTime": "' + "\\n" * 15 + '", "eventName": "x", "eventSource": "y"}', "Invalid CloudTrail eventTime"),
    ],
)
def test_a_bad_line_is_rejected_alone(lines_of, parse, log, bad, reason):
    good = log.splitlines()[0]
    parsed = parse(lines_of([bad, "  ", good]))
    assert [(r.line_number, r.reason, r.raw_event) for r in rejected(parsed).collect()] == [(1, reason, bad)]
    assert [r.line_number for r in accepted(parsed).collect()] == [3]


def test_severity_boundaries(spark):
    from pyspark.sql import functions as F

    scores = [100, 90, 89, 70, 69, 40, 39, 20, 19, 0]
    rows = spark.createDataFrame([(s,) for s in scores], "s int").select(severity_from_score(F.col("s")).alias("v")).collect()
    assert [r.v for r in rows] == ["critical"] * 2 + ["high"] * 2 + ["medium"] * 2 + ["low"] * 2 + ["informational"] * 2


def test_equal_addresses_are_one(lines_of):
    line = "Jul 27 10:00:0{} h sshd[1]: Failed password for a from {} port 1 ssh2"
    rows = accepted(parse_linux(lines_of([line.format(i, ip) for i, ip in enumerate(["2001:DB8::1", "2001:db8:0::1", "::ffff:1.2.3.4"])]))).collect()
    assert len({r.source_ip for r in rows[:2]}) == 1 and len(rows) == 3
