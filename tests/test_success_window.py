"""Successes after failures against a plain count, with a busy address over many tasks."""

import random

import pytest

from logwarden.operators.correlate import auth_moments, success_hits
from logwarden.plans.workarea import WorkArea
from logwarden.settings import DetectionSettings, SuccessAfterFailures

SECOND = 1_000_000


def plain(rows, window, threshold):
    out = {}
    for ip, at, failures, successes in rows:
        inside = [(a, f) for i, a, f, _ in rows if i == ip and f and at - window * SECOND <= a <= at]
        n = sum(f for _, f in inside)
        if successes and n >= threshold:
            out[ip, at] = (n, min(a for a, _ in inside))
    return out


@pytest.mark.parametrize(("window", "threshold", "span"), [(1, 1, 4 * SECOND), (2, 30, 60 * SECOND), (5, 3, 40)])
def test_counts_equal_a_plain_count(spark, window, threshold, span):
    rng = random.Random(threshold)
    rows = {}
    for _ in range(1200):
        key = (rng.choice(["10.0.0.1"] * 9 + ["10.0.0.2", "::1"]), rng.randrange(span))
        failures, successes = rows.get(key, (0, 0))
        rows[key] = (failures + rng.choice([0, 1, 1, 7]), successes + rng.choice([0, 0, 1]))
    rows = [(ip, at, f, s) for (ip, at), (f, s) in rows.items()]
    moments = spark.createDataFrame(rows, "source_ip string, at bigint, failures bigint, successes bigint").repartition(5)
    settings = DetectionSettings(successful_login_after_failures=SuccessAfterFailures(failure_threshold=threshold, window_seconds=window))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hits = success_hits(moments, settings, WorkArea(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.source_ip, r.at): (r.n, r.first_failure) for r in hits} == plain(rows, window, threshold)
    assert len(hits) == len({(r.source_ip, r.at) for r in hits})


def test_a_busy_address_is_spread_over_ranges(spark):
    from logwarden.operators.numbering import RANGE, deal
    from logwarden.operators.correlate import _window_rows
    from pyspark.sql import functions as F

    moments = spark.range(20_000).select(F.lit("10.0.0.1").alias("source_ip"), F.col("id").alias("at"), F.lit(1).cast("bigint").alias("failures"), (F.col("id") % 2).alias("successes"), F.lit(300).alias("window"), F.lit(1).alias("threshold"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = deal(_window_rows(moments), [F.col(c) for c in ("source_ip", "at", "kind", "of")], WorkArea(spark), "t")
        sizes = [r["count"] for r in dealt.groupBy(RANGE).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 0.6 * sum(sizes)


def test_moments_count_whole_microseconds(spark):
    rows = [("linux_auth", a, "10.0.0.1", t) for a, t in [("ssh_login_failed", 1), ("ssh_login_failed", 1), ("ssh_login_success", 1), ("ssh_login_failed", 2), ("other", 1)]]
    events = spark.createDataFrame([*rows, ("cisco_ios", "ssh_login_failed", "10.0.0.1", 1), ("linux_auth", "ssh_login_failed", None, 1)], "source string, action string, source_ip string, t bigint")
    got = auth_moments(events.selectExpr("source", "action", "source_ip", "timestamp_micros(t) as timestamp")).collect()
    assert sorted((r.at, r.failures, r.successes) for r in got) == [(1, 2, 1), (2, 1, 0)]
