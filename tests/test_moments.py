"""Moments and ids by casts and plain text functions, against the patterns they stand for; what ranking carries along."""

import hashlib

from pyspark.sql import functions as F

from logwarden import queries
from logwarden.functions.times import ISO, ISO_GROUPS, PLAIN_ISO, syslog_timestamp, with_iso_timestamp
from logwarden.schema import stable_id


def test_syslog_moments_are_those_of_the_pattern(spark):
    months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec Abc Anf Ebm".split() + [None]
    days, clocks = ["0", "1", "01", "9", "29", "30", "31", "32", "\u0663", None], ["00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:60", None]
    rows = spark.createDataFrame([(m, d, c) for m in months for d in days for c in clocks], "m string, d string, c string")
    for year in (2023, 2024):
        pattern = F.try_to_timestamp(F.concat_ws(" ", F.lit(str(year)), "m", "d", "c"), F.lit("yyyy MMM d HH:mm:ss"))
        got = rows.select("*", syslog_timestamp(year, F.col("m"), F.col("d"), F.col("c")).alias("now"), pattern.alias("was"))
        assert got.where("not (now <=> was)").collect() == []
        assert got.where("now is not null").count() > 120


def test_usual_iso_moments_pass_by_the_long_pattern(spark):
    texts = ["2024-07-27T20:15:01Z", "2024-02-30T20:15:01Z", "0000-01-01T00:00:00Z", "2024-07-27T24:00:00Z", "2024-07-27T20:60:01Z", "2024-07-27T20:15:01+00:00",
             "2024-07-27 20:15:01Z", "20240727T201501Z", "2024-07-27T20:15:01.5Z", "2024-07-27T20:15:01Z\n", None]
    rows = spark.createDataFrame([(t, t and t.replace("Z", "+00:00")) for t in texts], "text string, spelled string")
    got = with_iso_timestamp(with_iso_timestamp(rows, "text", "a"), "spelled", "b")  # the second never has the usual form
    assert got.where("not (a <=> b)").collect() == []
    assert [r.text for r in got.where("a is not null").collect()] == [texts[i] for i in (0, 5, 6, 7, 8)]
    assert rows.where(F.col("text").rlike(PLAIN_ISO)).count() == 4 and ISO_GROUPS == 15 and ISO


def test_ids_are_digests_in_groups(spark):
    got = spark.range(1).select(stable_id(F.lit("a"), F.lit("b")).alias("id")).first().id
    h = hashlib.sha256(b"a\nb").hexdigest()
    assert got == f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"


def test_ranking_carries_no_texts_of_the_rules(spark):
    files = [path for path in queries.ranked_alerts(spark, "/root/testdata/sf0.001").inputFiles() if "/ranked-" in path and "offsets" not in path]
    columns = spark.read.parquet(*files).columns
    assert "alert_id" in columns and "evidence" in columns and not {"description", "recommended_action"} & {*columns}
