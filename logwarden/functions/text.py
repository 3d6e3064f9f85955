"""Text helpers: whitespace, one-pass regex groups, timestamp text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as Python's str methods and patterns see it: Java's (?U)\s lacks \x1c-\x1f.
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[^\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """The text without whitespace at its ends. One that begins and ends with a printing ASCII character stays as it is,
    without a pattern that is tried at each of its characters.
    """
    printing = lambda at: F.ascii(F.substring(text, at, 1)).between(33, 126)
    return F.when(printing(1) & printing(-1), text).otherwise(F.regexp_replace(text, rf"(?U)^{WS}+|{WS}+\z", ""))


def match_groups(line: Column, pattern: str, count: int) -> Column:
    """All groups of a pattern that spans the whole line, in one regex pass.

    The result is an array with group i at index i when the line matches (see ``matched``), and one
    of size 1 when it does not. It relies on a line holding no line feed.
    """
    return F.split(F.regexp_replace(line, pattern, "".join(f"\n${i}" for i in range(1, count + 1))), "\n", -1)


def search_groups(line: Column, pattern: str, count: int, flags: str = "diU") -> Column:
    """``match_groups`` for a pattern that may stand anywhere; the leftmost place wins."""
    return match_groups(line, f"(?{flags})^.*?{pattern}.*$", count)


def matched(groups: Column) -> Column:
    return F.coalesce(F.size(groups) > 1, F.lit(False))


def quoted(text: Column) -> Column:
    """The text as Python's repr shows a printable string."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(text.contains("'") & ~text.contains('"'), double).otherwise(single)


def iso_text(moment: Column, zone: str) -> Column:
    """ISO text in UTC; the fraction is shown, with six digits, only when there is one."""
    fraction = F.when(
        F.pmod(F.unix_micros(moment), F.lit(1_000_000)) != 0, F.date_format(moment, ".SSSSSS")
    ).otherwise("")
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit(zone))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)
