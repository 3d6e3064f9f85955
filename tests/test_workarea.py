"""Written intermediate tables: small, unsorted, as they were."""

import json
from pathlib import Path

import pyarrow.parquet as pq

from logwarden.functions.text import strip
from logwarden.operators.alerts import detect
from logwarden.operators.cloudtrail import parse_cloudtrail
from logwarden.operators.routing import accepted, rejected, write_outcomes
from logwarden.plans.workarea import FOLDERS_AT_ONCE, SHREDDING, WorkArea
from logwarden.schema import DETECTION_COLUMNS, PARSED_COLUMNS
from logwarden.settings import DetectionSettings
from pyspark.sql import functions as F


def records(spark):
    base = {"eventTime": "2026-01-01T00:00:00Z", "eventName": "CreateRole", "eventSource": "iam.amazonaws.com", "sourceIPAddress": "192.0.2.1"}
    odd = [{}, "", 0, None, False, [], {"other": 1}, {"userName": "eve", "roleName": "admin"}, {"userName": None}, "x", 1, True, [1]]
    texts = [json.dumps(base | {name: value}) for name in ("userIdentity", "requestParameters") for value in odd]
    rows = [(text, "trail.jsonl", i + 1) for i, text in enumerate(texts + ["{", "", "null", "1", "{} {}", "　" + texts[0] + "\x1c"])]
    return spark.createDataFrame(rows, "value string, path string, line_number bigint"), len(odd)


def test_outcomes_are_written_packed_and_come_back(spark):
    lines, n = records(spark)
    work = WorkArea(spark)
    before = [spark.conf.get(FOLDERS_AT_ONCE, None), spark.conf.get(SHREDDING, None)]
    parsed = write_outcomes(parse_cloudtrail(lines), work)
    assert before == [spark.conf.get(FOLDERS_AT_ONCE, None), spark.conf.get(SHREDDING, None)]
    files = list(Path(work.path.removeprefix("file:")).rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    assert not any("typed_value" in str(pq.read_schema(f)) for f in files)
    user = F.coalesce("user_name", F.lit("-"))
    events = {r.line_number: (r.user, r.resource, r.given) for r in accepted(parsed).select("line_number", user.alias("user"), "resource", F.to_json("request_parameters").alias("given")).collect()}
    # what is empty or holds something counts; what holds something and is no object rejects the line
    assert sorted(events) == [*range(1, 10), *range(n + 1, n + 10), 2 * n + 6]
    assert events[8][0] == "eve" and events[7][0] == "-"
    assert events[n + 8][1:] == ("admin", '{"roleName":"admin","userName":"eve"}')
    assert [events[n + i][2] for i in (1, 2, 7, 9)] == ["{}", "{}", '{"other":1}', '{"userName":null}']
    reasons = {r.line_number: r.reason for r in rejected(parsed).collect()}
    assert {reasons[i] for i in (10, 11, 12, 13, n + 10, n + 13)} == {"CloudTrail userIdentity and requestParameters must be objects"}
    assert [reasons[2 * n + i].split(" at ")[0] for i in (1, 3, 4, 5)] == ["Invalid CloudTrail JSON", *["CloudTrail record must be an object"] * 2, "Invalid CloudTrail JSON"]


def test_a_record_is_taken_apart_in_one_pass(spark):
    plan = parse_cloudtrail(records(spark)[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$[0]") == 1
    assert not any(f"$.{name}" in plan for name in ("eventTime", "eventName", "eventSource", "userName", "groupId"))


def test_alerts_are_the_same_from_the_columns_that_rules_read(spark):
    lines, _ = records(spark)
    login = json.dumps({"eventTime": "2026-01-01T00:00:00Z", "eventName": "ConsoleLogin", "eventSource": "signin.amazonaws.com", "userIdentity": {"type": "Root"}})
    more = spark.createDataFrame([(login, "trail.jsonl", 100), (login.replace("ConsoleLogin", "StopLogging"), "trail.jsonl", 101)], lines.schema)
    parsed = parse_cloudtrail(lines.unionByName(more))
    found, rows = [], []
    for columns in (PARSED_COLUMNS, DETECTION_COLUMNS):
        work = WorkArea(spark)
        written = write_outcomes(parsed, work, columns=columns)
        assert set(written.columns) == set(columns)
        found.append(sorted(map(str, detect(accepted(written), DetectionSettings(), work).collect())))
        rows.append(sorted(map(tuple, written.groupBy("source", "fate").count().collect())))
    assert len(found[0]) == 2 and found[0] == found[1] and rows[0] == rows[1]


def test_strip_is_as_it_was(spark):
    texts = ["", " ", "a", " a", "a ", "　a b\x1f", "é ", " é", "é", "\x85a", "a\xa0", "~!", "\x1ca\n", "a​", "\x00a\x00"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", strip(F.col("t")).alias("s")).collect()
    assert all(r.s == (None if r.t is None else r.t.strip()) for r in rows)
