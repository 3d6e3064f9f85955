"""Severity bands of a risk score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest score of each level, highest level first. Fixed values.
SEVERITY_FLOOR = {"critical": 90, "high": 70, "medium": 40, "low": 20}
LOWEST = "informational"
SEVERITIES = [*SEVERITY_FLOOR, LOWEST]


def severity_from_score(score: Column) -> Column:
    (first, floor), *rest = SEVERITY_FLOOR.items()
    level = F.when(score >= floor, first)
    for name, floor in rest:
        level = level.when(score >= floor, name)
    return level.otherwise(LOWEST)
