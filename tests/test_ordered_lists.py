"""Alerts with their lists, in order, against the unordered ones; what is shuffled and sorted holds no lists."""

import pytest

from logwarden.operators.alerts import alert_order
from logwarden.operators.members import listed_events, listed_in_order


def shown(rows):
    return [(r.alert_id, r.part, r.parts, r.event_ids) for r in rows]


def test_order_and_lists(result):
    rows = listed_in_order(result.alerts, result.events, result.settings, result.work, alert_order()).collect()
    assert [r.alert_id for r in rows] == [r.alert_id for r in result.alerts.orderBy(*alert_order()).collect()]
    assert sorted(shown(rows)) == sorted(shown(result.documents.collect()))
    assert {r.rule_id: len(r.event_ids) for r in rows}["LINUX-AUTH-003"] == 5


@pytest.mark.parametrize("chunk", [1, 2, 3, 5])
def test_parts_and_repeated_alerts(result, chunk):
    for alerts in (result.alerts, result.alerts.unionByName(result.alerts.where("rule_id like 'LINUX%'"))):
        given = alerts, result.events, result.settings, result.work
        rows = listed_in_order(*given, alert_order(), chunk=chunk).collect()
        assert sorted(shown(rows), key=str) == sorted(shown(listed_events(*given, chunk=chunk).collect()), key=str)
        order = [(-r.risk_score, -r.detected_at.timestamp(), r.seen, r.alert_id, r.part) for r in rows]
        assert order == sorted(order)


def test_no_list_is_shuffled_or_sorted(result):
    plan = result.ranked_documents._jdf.queryExecution().executedPlan().toString().splitlines()
    top = next(i for i, line in enumerate(plan) if "Join" in line)
    assert "ShuffledHashJoin" in plan[top] and not any("Exchange" in line or "Sort" in line for line in plan[:top])
    assert any("Sort [risk_score" in line for line in plan[top:])  # it is still there below the join
