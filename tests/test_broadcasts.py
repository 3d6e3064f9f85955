"""Tables that are copied once per salt outgrow their written file's size, so they must not be broadcast by it."""

from logwarden.operators.alerts import detect
from logwarden.operators.members import alert_members


def joins(table, column):
    plan = table._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Join" in line and f"{column}#" in line]


def test_moments_of_successes_are_shuffled(result):
    found = detect(result.events, result.settings, result.work, {"LINUX-AUTH-003"})
    salted = joins(found.select("rule_id"), "salt")
    assert len(salted) == 1 and "SortMergeJoin" in salted[0]
    assert found.count() == 1


def test_alerts_that_meet_their_events_are_shuffled(result):
    salted = joins(alert_members(result.events, result.alerts, result.settings), "salt")
    assert len(salted) == 4 and all("SortMergeJoin" in line for line in salted)
