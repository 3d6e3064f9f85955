"""Timestamps from syslog headers and from ISO 8601 text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions.text import match_groups

MICROS = 1_000_000
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def syslog_timestamp(year: int, month: Column, day: Column, clock: Column) -> Column:
    """Null when the date or the time of day does not exist. The month is a capital letter and two small ones; a cast
    reads a moment of fixed form several times faster than a pattern of letters does.
    """
    place = F.instr(F.lit(MONTHS), month) + 2
    text = F.concat(F.lit(f"{year}-"), F.when(place > 2, (place / 3).cast("int")), F.lit("-"), day, F.lit(" "), clock)
    return text.try_cast("timestamp")


# Date with or without dashes; then any one character and a time with or without colons, down to
# hours only, with a fraction of any length; then an optional offset of the same build.
ISO = (
    r"(?s)^(?!0000)([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})"
    r"(?:.([0-9]{2})(?:(:?)([0-9]{2})(?:\6([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    r"(?:([+-])([0-9]{2})(?:(:?)([0-9]{2})(?:\12([0-9]{2})(?:[.,]([0-9]+))?)?)?)?)?\z"
)
ISO_GROUPS = 15
# The usual form, which a cast reads as it is.
PLAIN_ISO = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"


def with_iso_timestamp(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add the UTC moment of an ISO text; no offset means UTC; null when the text is not valid."""
    groups, local, offset, plain = f"_{out}_groups", f"_{out}_local", f"_{out}_offset", f"_{out}_plain"
    part = lambda i: F.get(groups, F.lit(i))
    given = lambda i, default: F.when(part(i) != "", part(i)).otherwise(default)
    number = lambda i: F.when(part(i) != "", part(i).try_cast("bigint")).otherwise(0)
    date = F.concat_ws("-", part(1), part(3), part(4))
    clock = F.concat_ws(":", given(5, "00"), given(7, "00"), given(8, "00"))
    shifted = F.timestamp_micros(F.unix_micros(local) - F.col(offset) * MICROS)
    return (
        rows.withColumn(plain, F.col(text).rlike(PLAIN_ISO))
        .withColumn(
            groups,
            # A decoded JSON text may hold line feeds: only one that matches is taken apart.
            F.when(
                ~F.col(plain) & F.replace(F.col(text), F.lit("Z"), F.lit("+00:00")).rlike(ISO),
                match_groups(F.replace(F.col(text), F.lit("Z"), F.lit("+00:00")), ISO, ISO_GROUPS),
            ),
        )
        .withColumns(
            {
                local: F.when(F.col(plain), F.col(text).try_cast("timestamp")).when(
                    F.size(groups) == ISO_GROUPS + 1,
                    F.concat(
                        date, F.lit(" "), clock, F.lit("."), F.substring(given(9, "0"), 1, 6), F.lit("+00:00")
                    ).try_cast("timestamp"),
                ),
                offset: F.when(part(10) == "-", -1).otherwise(1)
                * (number(11) * 3600 + number(13) * 60 + number(14)),
            }
        )
        .withColumn(out, F.when(F.abs(offset) < 86400, shifted))
        .drop(groups, local, offset, plain)
    )


def floor_bucket(moment: Column, seconds: int) -> Column:
    """Number of the fixed time bucket a moment falls into."""
    micros, width = F.unix_micros(moment), F.lit(seconds * MICROS)
    return ((micros - F.pmod(micros, width)) / width).cast("bigint")
