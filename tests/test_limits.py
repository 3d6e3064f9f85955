"""Limits of single keys, next to the settings."""

from datetime import datetime, timedelta

from logwarden.operators.alerts import detect
from logwarden.operators.cisco import parse_cisco
from logwarden.operators.limits import SCHEMA, longest_window
from logwarden.operators.linux import parse_linux
from logwarden.operators.members import alert_members, event_places
from logwarden.operators.routing import accepted
from logwarden.plans.workarea import WorkArea
from logwarden.settings import DetectionSettings

START = datetime(2026, 7, 27, 10)


def login(seconds, ip, verb="Failed"):
    return f"{START + timedelta(seconds=seconds):%b %d %H:%M:%S} h sshd[1]: {verb} password for a from {ip} port 22 ssh2"


def test_an_address_has_its_own_limits(spark, lines_of):
    work, settings = WorkArea(spark), DetectionSettings()
    lines = [login(s, ip) for ip in ("10.0.0.1", "10.0.0.2", "10.0.0.3") for s in (0, 700, 1500)] + [login(2000, ip, "Accepted") for ip in ("10.0.0.1", "10.0.0.2")]
    events = accepted(work.write(parse_linux(lines_of(lines)), "parsed"))
    rows = [("LINUX-AUTH-001", "10.0.0.1", 3, 1500), ("LINUX-AUTH-001", "10.0.0.3", 3, None), ("LINUX-AUTH-003", "10.0.0.2", None, 2000), ("LINUX-AUTH-001", "10.0.0.2", 9, 9999), ("LINUX-AUTH-002", None, 0, 1)]
    limits = spark.createDataFrame(rows, SCHEMA)
    assert detect(events, settings, work).count() == 0
    alerts = work.write(detect(events, settings, work, limits=limits), "alerts")
    found = {r.alert_id: (r.rule_id, r.source_ip, r.event_count) for r in alerts.collect()}
    assert sorted(found.values()) == [("LINUX-AUTH-001", "10.0.0.1", 3), ("LINUX-AUTH-003", "10.0.0.2", 4)]
    places = event_places(alert_members(events, alerts, settings, limits), work).collect()
    assert sorted((found[r.alert_id][0], r.place) for r in places) == [("LINUX-AUTH-001", n) for n in (1, 2, 3)] + [("LINUX-AUTH-003", n) for n in (1, 2, 3, 4)]


def test_a_host_has_its_own_window(spark, lines_of):
    work = WorkArea(spark)
    line = lambda s, host, state: f"{START + timedelta(seconds=s):%b %d %H:%M:%S} {host} %LINK-3-UPDOWN: Interface Gi0/1, changed state to {state}"
    events = accepted(work.write(parse_cisco(lines_of([line(s, h, x) for h in ("A", "B") for s, x in ((0, "down"), (1000, "up"))])), "parsed"))
    limits = spark.createDataFrame([("CISCO-NET-001", "B", None, 1000), ("CISCO-NET-001", "B", None, 10)], SCHEMA)
    assert [r.host_name for r in detect(events, DetectionSettings(), work, limits=limits).collect()] == ["B"]
    assert longest_window(limits, "CISCO-NET-001", 300) == 1000 and longest_window(limits, "LINUX-AUTH-001", 300) == 300 and longest_window(None, "x", 5) == 5
