"""Python's view of JSON values held in a VARIANT: truth and text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "variant")


def fields(value: Column, path: str, names: Iterable[str]) -> Column:
    """Several fields of an object, each as ``field`` has it, in one pass; null when there is no object."""
    return F.try_variant_get(value, path, "struct<" + ", ".join(f"{name}: variant" for name in names) + ">")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def is_text(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def text_or_null(value: Column) -> Column:
    return F.when(is_text(value), F.try_variant_get(value, "$", "string"))


# Text of the values that count as false, texts aside. Fixed values.
FALSY = r"^(?:false|\{\}|\[\]|-?0(?:\.0*)?(?:[eE][-+]?[0-9]+)?)\z"


def plain_text(value: Column) -> Column:
    """The value as JSON has it, a text without its quotes."""
    return F.try_variant_get(value, "$", "string")


def truthy(value: Column, known: tuple[Column, Column] | None = None) -> Column:
    """False for a missing value, null, false, zero, and an empty text, list or object.

    ``known`` are columns with the value's ``kind`` and ``plain_text``, so that neither is worked out again.
    """
    what, text = known or (kind(value), plain_text(value))
    return F.coalesce(F.when(what == "STRING", text != "").otherwise(~text.rlike(FALSY)), F.lit(False))


def as_text(value: Column, known: tuple[Column, Column] | None = None) -> Column:
    """The value as text; booleans the way Python prints them, nested values as JSON; ``known`` as in ``truthy``."""
    what, text = known or (kind(value), plain_text(value))
    return F.when(what == "BOOLEAN", F.initcap(text)).otherwise(text)
