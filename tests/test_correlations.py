"""Boundaries of the rules over groups, on events given directly."""

from datetime import datetime, timedelta

import pytest

from logwarden.operators.alerts import detect
from logwarden.operators.linux import parse_linux
from logwarden.operators.members import alert_members, with_event_ids
from logwarden.operators.routing import accepted
from logwarden.plans.workarea import WorkArea
from logwarden.settings import DetectionSettings

START = datetime(2026, 7, 27, 10)


@pytest.fixture
def alerts_of(spark, lines_of):
    def build(lines):
        work = WorkArea(spark)
        events = accepted(work.write(parse_linux(lines_of(lines)), "parsed"))
        alerts = work.write(detect(events, DetectionSettings(), work), "alerts")
        return with_event_ids(alerts, alert_members(events, alerts, DetectionSettings()), work).collect(), events

    return build


def login(seconds, user="a", verb="Failed", ip="10.0.0.1", invalid=False):
    at = START + timedelta(seconds=seconds)
    return f"{at:%b %d %H:%M:%S} h sshd[1]: {verb} password for {'invalid user ' * invalid}{user} from {ip} port 22 ssh2"


def rules(rows):
    return sorted(r.rule_id for r in rows)


@pytest.mark.parametrize(("last", "found"), [(300, ["LINUX-AUTH-001"]), (301, [])])
def test_span_of_a_brute_force_is_inclusive(alerts_of, last, found):
    rows, _ = alerts_of([login(s) for s in (0, 1, 2, last)])
    assert rules(rows) == found


def test_three_failures_are_no_brute_force(alerts_of):
    assert alerts_of([login(s) for s in (0, 1, 2)])[0] == []


@pytest.mark.parametrize(("success", "n"), [(300, 3), (301, None), (2, 3)])
def test_success_after_failures(alerts_of, success, n):
    rows, _ = alerts_of([login(0), login(1), login(2), login(success, verb="Accepted", user="b")])
    rows = [r for r in rows if r.rule_id == "LINUX-AUTH-003"]
    assert [r.evidence[0] for r in rows] == ([f"{n} failures before success"] if n else [])


def test_a_large_group_lists_all_its_events_and_names(alerts_of):
    rows, events = alerts_of([login(i % 200, user=f"u{i % 50:02}", invalid=i % 2 == 0) for i in range(20_000)])
    assert rules(rows) == ["LINUX-AUTH-001", "LINUX-AUTH-002"]
    names = {r.rule_id: r.evidence[-1] for r in rows}
    assert names["LINUX-AUTH-001"] == "Targeted users: " + ", ".join(f"u{i:02}" for i in range(50))
    order = [r.event_id for r in events.orderBy("timestamp", "line_number").collect()]
    assert {r.rule_id: len(r.event_ids) for r in rows} == {"LINUX-AUTH-001": 20_000, "LINUX-AUTH-002": 10_000}
    assert next(r.event_ids for r in rows if r.rule_id == "LINUX-AUTH-001") == order
