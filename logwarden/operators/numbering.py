"""Consecutive numbers over sorted tables, without bringing a table or a group into one task.

The rows are dealt by ranges of their order, sorted in each, and written with the range and the row in it. A range's
count (of each group that reaches into it) is one small row; the running sums of these give what stands before a
range, and adding a row's place in its range gives its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.plans.workarea import WorkArea

RANGE, ROW = "numbering_range", "numbering_row"


def deal(table: DataFrame, order: list[Column], work: WorkArea, name: str, parts: int | None = None) -> DataFrame:
    """The table written in ranges of `order`, each sorted, with the range and the row in it; `parts` ranges, or few for a small table.

    Rows equal in the whole order stand in one range: the order must tell the rows of a large group apart.
    """
    ranges = table.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    numbered = ranges.withColumns({RANGE: F.spark_partition_id(), ROW: F.monotonically_increasing_id()})
    return work.write(numbered, work.fresh(name))


def _before(groups: list[str]):
    return Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def numbered(
    table: DataFrame, order: list[Column], work: WorkArea, name: str, out: str, groups: list[str] | None = None
) -> DataFrame:
    """The table with `out`: numbers from 1 in the given order, in all or in each group of `groups`.

    Nulls are groups of their own. `order` names sort columns without the groups, which come first.
    """
    groups = groups or []
    dealt = deal(table, [*map(F.col, groups), *order], work, name)
    counts = dealt.groupBy(*groups, RANGE).agg(F.count(F.lit(1)).alias("n"), F.min(ROW).alias("first_row"))
    before = F.coalesce(F.sum("n").over(_before(groups)), F.lit(0))
    offsets = work.write(counts.select(*groups, RANGE, (before - F.col("first_row") + 1).alias("shift")), work.fresh(f"{name}-offsets"))
    left, right = dealt.alias("l"), offsets.alias("r")
    same = F.col(f"l.{RANGE}") == F.col(f"r.{RANGE}")
    for group in groups:
        same &= F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))
    number = (F.col(f"l.{ROW}") + F.col("r.shift")).alias(out)
    return left.join(right, same).select(*[F.col(f"l.{c}") for c in table.columns], number)
