from samples import GOLDEN_ALERTS, GOLDEN_EVIDENCE

from logwarden import analyze
from logwarden.operators.alerts import rank_alerts
from logwarden.operators.reporting import severity_counts


def check_alerts(result):
    rows = rank_alerts(result.alerts).collect()
    ids = {r.alert_id: r.event_ids for r in result.documents.collect()}
    assert len(rows) == len(GOLDEN_ALERTS)
    for row, (rule, score, severity, clock, last, user, resource) in zip(rows, GOLDEN_ALERTS):
        assert (row.rule_id, row.risk_score, row.severity) == (rule, score, severity)
        assert row.detected_at.strftime("%Y-%m-%d %H:%M:%S") == f"2026-07-27 {clock}"
        assert row.source_ip == (last and f"198.51.100.{last}")
        assert (row.user_name, row.resource) == (user, resource)
        own = [e for e in row.evidence if not e.startswith(("Action: ", "Message: "))]
        assert own == GOLDEN_EVIDENCE[rule]
        assert len(ids[row.alert_id]) == len(set(ids[row.alert_id])) == row.event_count


def test_alerts_in_order(result):
    check_alerts(result)


def test_ids_do_not_depend_on_how_files_are_split(spark, sample_paths, result):
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "120")
    try:
        split = analyze(spark, **sample_paths)
        ids = lambda r: sorted((a.alert_id, a.event_ids) for a in r.documents.collect())
        assert ids(split) == ids(result)
        assert sorted(r.line_number for r in split.events.where("source = 'linux_auth'").collect()) == [1, 2, 3, 4, 5, 6]
    finally:
        spark.conf.set(key, before)


def test_files_without_lines_have_a_row(spark, sample_paths, tmp_path):
    (tmp_path / "empty.log").write_text("")
    more = {**sample_paths, "linux": [sample_paths["linux"], str(tmp_path / "empty.log")]}
    rows = analyze(spark, **more).sources.where("source = 'linux_auth'").collect()
    assert sorted((r.path.rsplit("/", 1)[-1], r.parsed_events, r.rejected_events) for r in rows) == [("empty.log", 0, 0), ("linux.log", 6, 0)]


def test_counts(result):
    assert result.run_summary.collect()[0].asDict() == {
        "events_analyzed": 15,
        "events_rejected": 0,
        "alerts_generated": 10,
    }
    found = {r.severity: r.alerts for r in severity_counts(result.alerts).collect()}
    assert found == {"critical": 5, "high": 2, "medium": 3, "low": 0, "informational": 0}
    sources = result.sources.orderBy("source_rank").collect()
    assert [(s.name, s.parsed_events, s.rejected_events) for s in sources] == [
        ("Cisco IOS Syslog", 5, 0),
        ("Linux Authentication", 6, 0),
        ("AWS CloudTrail", 4, 0),
    ]
