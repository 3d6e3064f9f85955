"""What is read and computed of parsed lines: only the wanted outcome, only the wanted columns."""

from pyspark.sql import functions as F

from logwarden.operators.alerts import events_in_input_order
from logwarden.operators.cisco import parse_cisco
from logwarden.operators.cloudtrail import parse_cloudtrail
from logwarden.operators.linux import parse_linux
from logwarden.operators.routing import accepted, rejected, union_sources, write_outcomes
from logwarden.plans.workarea import WorkArea
from samples import CISCO_LOG, CLOUDTRAIL_LOG, LINUX_LOG


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_rejects_are_read_from_their_own_files(spark, lines_of):
    parsed = write_outcomes(parse_linux(lines_of(["none", "", *LINUX_LOG.splitlines(), "Feb 30 10:00:00 h sshd[1]: x"])), WorkArea(spark))
    assert sorted((r.line_number, r.reason) for r in rejected(parsed).collect()) == [(1, "Unsupported Linux auth format at line 1"), (9, "Invalid Linux auth timestamp")]
    assert [r.line_number for r in accepted(parsed).orderBy("line_number").collect()] == list(range(3, 9))
    plan = plan_of(rejected(parsed))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "(fate" in scan.split("PartitionFilters:")[1].split("]")[0] and " = reject)" in scan
    read = scan.split("ReadSchema:")[1]
    assert "raw_event" in read and "attributes" not in read and "event_id" not in read


def test_columns_that_nobody_reads_are_not_computed(lines_of):
    events = accepted(parse_cloudtrail(lines_of(CLOUDTRAIL_LOG.splitlines())))
    assert "sha2(" in plan_of(events) and "to_variant_object" in plan_of(events)
    few = plan_of(events.select("line_number", "action"))
    assert "sha2(" not in few and "to_variant_object" not in few and "arn" not in few


def test_a_parser_is_not_copied_into_filters_above_it(lines_of):
    events = accepted(parse_linux(lines_of(LINUX_LOG.splitlines())))
    once = plan_of(events.select("user_name"))
    more = plan_of(events.where((F.col("user_name") != "x") & F.col("source_ip").isNotNull() & (F.col("action") == "ssh_login_failed")).select("user_name"))
    assert len(more) < 2 * len(once)


def test_another_source_is_dropped_from_the_plan(lines_of):
    both = accepted(union_sources(parse_cisco(lines_of(CISCO_LOG.splitlines())), parse_linux(lines_of(LINUX_LOG.splitlines()))))
    plan = plan_of(both.where("source = 'linux_auth'"))
    assert "Union" not in plan


def test_events_come_in_input_order(spark, lines_of, tmp_path):
    cisco, linux = parse_cisco(lines_of(CISCO_LOG.splitlines(), "/b")), parse_linux(lines_of(LINUX_LOG.splitlines() * 30, "/a"))
    events_in_input_order(accepted(union_sources(linux, cisco))).select("source_rank", "path", "line_number").write.json(str(tmp_path / "o"))
    rows = []
    for part in sorted((tmp_path / "o").glob("part-*")):
        rows += [tuple(r) for r in spark.read.schema("source_rank int, path string, line_number bigint").json(str(part)).collect()]
    assert rows == sorted(rows) and len(rows) == 185
