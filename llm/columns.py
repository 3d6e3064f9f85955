"""Other columns of a table, kept out of an operator's way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def set_aside(docs: DataFrame, own: list[str], made: list[str], last: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with the `own` columns, and all others under names that no operator uses; and what gives a result of it
    the columns of `docs` back and adds those `made`. A column of `docs` that is named like one made gives way to it; those of `last`
    come after the others."""
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    hidden = {c: f"set aside {i}" for i, c in enumerate(docs.columns) if c not in own}
    inside = docs.select(*own, *[F.col(quoted(c)).alias(h) for c, h in hidden.items()])

    def back(found: DataFrame) -> DataFrame:
        names = [c for c in docs.columns if c not in made and c not in last]
        return found.select(*[F.col(quoted(hidden.get(c, c))).alias(c) for c in names], *last, *made)

    return inside, back
