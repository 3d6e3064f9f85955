"""The query over alert documents, on rows of its own."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logwarden.queries import QUERIES

KINDS = ["error", "signup", "error", "click", "view", "purchase"]


def test_documents_are_parsed_once_and_hold_all_events(spark, tmp_path):
    start = datetime(2024, 1, 1, 10)
    rows = [(i, start + timedelta(seconds=20 * i), 4 * (i % 3), KINDS[i % 6]) for i in range(36)]
    table = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    table.write.parquet(f"{tmp_path}/events.parquet")
    docs = QUERIES["alert_docs"](spark, str(tmp_path))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    # the lists come from six branches, and none reads a document twice
    assert plan.count("from_json") == 6 and all(line.count("from_json") < 2 for line in plan.splitlines()) and "get_json_object" not in plan
    found = sorted((r.rule_id, r.at, r.listed_events) for r in docs.collect())
    brute = [(rule, at, n) for rule, at, n in found if rule == "LINUX-AUTH-001"]
    assert brute == [("LINUX-AUTH-001", "2024-01-01T10:10:40Z", 18)]
    success = [n for rule, _, n in found if rule == "LINUX-AUTH-003"]
    assert success == [3 * (i + 1) + 1 for i in range(6)]
    assert {n for rule, _, n in found if rule.startswith("AWS")} == {1}
    assert {r.document_kind for r in docs.collect()} == {"security_alert"}
