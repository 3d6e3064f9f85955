"""Thresholds and windows of single keys, as a table next to the settings.

A row holds for one rule and one key: the address for rules over logins, the host for interface changes. What a row leaves null,
and every key without a row, has the value of the settings. Of several rows for a rule and key the strictest counts: the
least threshold and the longest window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "rule_id string, key string, threshold bigint, window_seconds bigint"


def limits_of(limits: DataFrame | None, rule_id: str) -> DataFrame | None:
    """key, threshold and window_seconds of one rule, a row for each key."""
    if limits is None:
        return None
    own = limits.where((F.col("rule_id") == rule_id) & F.col("key").isNotNull())
    return own.groupBy("key").agg(F.min("threshold").alias("threshold"), F.max("window_seconds").alias("window_seconds"))


def with_limits(
    table: DataFrame, limits: DataFrame | None, rule_id: str, key: str, threshold: int | None, window: int, prefix: str = ""
) -> DataFrame:
    """The table with `<prefix>threshold` and `<prefix>window`, by its column `key`."""
    own = limits_of(limits, rule_id)
    names = f"{prefix}threshold", f"{prefix}window"
    given = [F.lit(threshold).cast("bigint"), F.lit(window).cast("bigint")]
    if own is None:
        return table.withColumns(dict(zip(names, given)))
    renamed = own.select(F.col("key").alias(key), F.col("threshold").alias(names[0]), F.col("window_seconds").alias(names[1]))
    joined = table.join(renamed, key, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), default) for name, default in zip(names, given)})


def longest_window(limits: DataFrame | None, rule_id: str, window: int) -> int:
    """The longest window any key of a rule has."""
    own = limits_of(limits, rule_id)
    longest = None if own is None else own.agg(F.max("window_seconds").alias("w")).first().w
    return max(window, longest or 0)
