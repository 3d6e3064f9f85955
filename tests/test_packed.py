"""Files whose documents list almost the same events, packed."""

from pyspark.sql import functions as F

from logwarden.sources.sinks import ZSTD, packed, write_bulk


def test_overlapping_lists_take_little_room_and_are_read_again(spark, tmp_path):
    ids = F.transform(F.sequence(F.col("id"), F.col("id") + 1199), lambda x: F.substring(F.sha2(x.cast("string"), 256), 1, 36))
    rows = spark.range(0, 600, 1, 2).select(F.when(F.col("id") % 3 == 0, "events").otherwise("alerts").alias("_index"), F.to_json(F.struct(ids.alias("event_ids"))).alias("document"))
    path = tmp_path / "bulk"
    assert write_bulk(rows, str(path), "events", "alerts", compression=ZSTD) == {"events": 200, "alerts": 400}
    text = rows.agg(F.sum(F.length("document"))).first()[0]
    assert sum(f.stat().st_size for f in path.glob("*/part-*")) < text / 50
    held = packed(spark).text(str(path)).where("value not like '{\"index\":%'")
    assert held.count() == 600 and held.select("_index", F.col("value").alias("document")).exceptAll(rows).isEmpty()
