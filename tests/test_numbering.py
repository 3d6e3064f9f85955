"""Ranks, places of events and documents in parts, over tasks."""

import random

from pyspark.sql import functions as F

from logwarden.operators.alerts import rank_alerts, ranked_alerts
from logwarden.operators.ecs import to_alert_documents
from logwarden.operators.members import alert_members, event_places, listed_events, listed_places, with_event_ids
from logwarden.operators.numbering import numbered
from logwarden.plans.workarea import WorkArea


def test_numbers_of_a_table_and_of_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randint(0, 30), i) for i in range(3000)]
    table = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    key = lambda r: (r[1], r[2])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        whole = numbered(table, [F.col("v"), F.col("i")], WorkArea(spark), "t", "n").collect()
        inside = numbered(table, [F.col("v"), F.col("i")], WorkArea(spark), "t", "n", ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [tuple(r)[:3] for r in sorted(whole, key=lambda r: r.n)] == sorted(rows, key=key)
    assert sorted(r.n for r in whole) == list(range(1, 3001))
    for k in ("hot", "a", "b", None):
        got = sorted((r for r in inside if r.k == k), key=lambda r: r.n)
        assert [r.n for r in got] == list(range(1, len(got) + 1))
        assert [tuple(r)[:3] for r in got] == sorted((r for r in rows if r[0] == k), key=key)


def test_nothing_to_number(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert numbered(empty, [F.col("v")], WorkArea(spark), "t", "n", ["k"]).collect() == []


def test_ranks_follow_the_order_of_alerts(spark, result):
    ranked = ranked_alerts(result.alerts, WorkArea(spark)).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 11))
    assert [r.alert_id for r in ranked] == [r.alert_id for r in rank_alerts(result.alerts).collect()]


def test_large_alerts_have_documents_in_parts(spark, result):
    work = WorkArea(spark)
    members = result.members()
    whole = {r.alert_id: r.event_ids for r in with_event_ids(result.alerts, members, work).collect()}
    cut = with_event_ids(result.alerts, members, work, chunk=2).collect()
    for alert_id, ids in whole.items():
        parts = sorted((r for r in cut if r.alert_id == alert_id), key=lambda r: r.part)
        assert [r.part for r in parts] == list(range(1, parts[0].parts + 1))
        assert [i for r in parts for i in r.event_ids] == ids and all(len(r.event_ids) <= 2 for r in parts)
    places = event_places(members, work).collect()
    assert sorted((r.alert_id, r.place, r.event_id) for r in places) == sorted((a, n, i) for a, ids in whole.items() for n, i in enumerate(ids, 1))
    documents = to_alert_documents(with_event_ids(result.alerts, members, work, chunk=2))
    fields = documents.select(F.get_json_object("document", "$.event_ids_part").alias("part"), F.json_array_length(F.get_json_object("document", "$.event_ids")).alias("n")).collect()
    assert sum(r.n for r in fields) == sum(map(len, whole.values()))
    assert all((r.part is None) == (sum(x.alert_id == a for x in cut) == 1) for r, a in zip(fields, [d.alert_id for d in documents.collect()]))
    no_parts = to_alert_documents(with_event_ids(result.alerts, members, work)).where("document like '%event_ids_part%'")
    assert no_parts.count() == 0


def test_an_alert_without_known_events_has_one_row(spark, result):
    none = result.members().where("false")
    rows = with_event_ids(result.alerts, none, WorkArea(spark)).collect()
    assert len(rows) == 10 and {(r.part, r.parts, r.event_ids) for r in rows} == {(1, 1, None)}


def test_lists_without_rows_of_members_equal_those_of_them(spark, result):
    work = WorkArea(spark)
    twice = result.alerts.union(result.alerts.orderBy("alert_id").limit(4))  # ids that alerts have in common
    for alerts in (result.alerts, twice):
        members = alert_members(result.events, alerts, result.settings)
        for chunk in (2, 4, 100_000):  # pairs of buckets that are too large, some of them, and none
            want = with_event_ids(alerts, members, work, chunk)
            got = listed_events(alerts, result.events, result.settings, work, chunk=chunk)
            shown = lambda t: sorted((r.alert_id, r.part, r.parts, r.event_ids, r.rule_id) for r in t.collect())
            assert shown(got) == shown(want)
            if alerts is result.alerts:
                places = sorted((r.alert_id, r.place, r.event_id) for r in listed_places(got, chunk).collect())
                assert places == sorted((r.alert_id, r.place, r.event_id) for r in event_places(members, work).collect())


def test_lists_of_small_alerts_write_no_row_for_each_of_their_events(spark, result, monkeypatch):
    seen = []
    write = WorkArea.write
    monkeypatch.setattr(WorkArea, "write", lambda self, table, name, *by: seen.append((name, write(self, table, name, *by))) or seen[-1][1])
    listed = result.documents
    assert sum(len(r.event_ids) for r in listed.collect()) > 10
    assert sum(t.count() for name, t in seen if name.startswith(("members", "event-places"))) == 0
