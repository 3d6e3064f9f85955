"""IP addresses as built-in expressions, so that no row leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
DOTTED = rf"{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}"
IPV4 = rf"^{DOTTED}\z"
IPV4_TAIL = rf"^([^.]*:){DOTTED}\z"
HEXTET = r"[0-9A-Fa-f]{1,4}"
IPV6_FULL = rf"^{HEXTET}(?::{HEXTET}){{7}}\z"
IPV6_SHORT = rf"^(?:{HEXTET}(?::{HEXTET})*)?::(?:{HEXTET}(?::{HEXTET})*)?\z"

# The longest run of two or more zero groups, the first one among equals: one alternative per run
# length, longest first. Text before and after the run lands in the odd and the even groups.
ZERO_RUN = "^(?:" + "|".join(rf"(?:|(.*?):)0(?::0){{{n - 1}}}(?:|:(.*))" for n in range(8, 1, -1)) + r")\z"
ZERO_RUN_SHORT = "".join(f"${i}" for i in range(1, 15, 2)) + "::" + "".join(f"${i}" for i in range(2, 15, 2))

MAPPED = r"^0:0:0:0:0:ffff:([0-9a-f]+):([0-9a-f]+)\z"


def _int(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def _hex_pair(text: Column, first: int) -> Column:
    high, low = (_int(F.regexp_extract(text, IPV4_TAIL, first + i)) for i in (0, 1))
    return F.lower(F.hex(high * 256 + low))


def _dotted(group: Column) -> Column:
    value = _int(F.conv(group, 16, 10))
    return F.concat_ws(".", F.floor(value / 256).cast("string"), (value % 256).cast("string"))


def with_canonical_ip(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add the canonical spelling of the address in a column; null where it is no IPv4 or IPv6 address.

    Every step is a column of its own, so that no expression repeats another one inside it.
    """
    t, address, scope, hextets, plain = (F.col(f"_{out}_{n}") for n in ("v6", "address", "scope", "hextets", "plain"))
    groups = F.length(F.replace(F.regexp_replace(hextets, "[0-9A-Fa-f]+", "x"), F.lit(":"), F.lit("")))
    expanded = F.when(hextets.rlike(IPV6_FULL), hextets).when(
        hextets.rlike(IPV6_SHORT) & (groups <= 7),
        F.trim(
            F.concat(
                F.substring_index(hextets, "::", 1),
                F.lit(":"),
                F.repeat(F.lit("0:"), (8 - groups).cast("int")),
                F.substring_index(hextets, "::", -1),
            ),
            F.lit(":"),
        ),
    )
    shown = F.when(
        plain.rlike(MAPPED),
        F.concat(
            F.lit("::ffff:"),
            _dotted(F.regexp_extract(plain, MAPPED, 1)),
            F.lit("."),
            _dotted(F.regexp_extract(plain, MAPPED, 2)),
        ),
    ).otherwise(F.regexp_replace(plain, ZERO_RUN, ZERO_RUN_SHORT))
    name = lambda column: f"_{out}_{column}"
    return (
        rows.withColumn(name("v6"), F.when(F.col(text).contains(":") & ~F.col(text).contains("/"), F.col(text)))
        .withColumn(name("address"), F.substring_index(t, "%", 1))
        # "%scope" is kept; an empty one or one with a further "%" makes the text invalid.
        .withColumn(name("scope"), F.substring(t, F.length(address) + 1, F.length(t)))
        .withColumn(
            name("hextets"),
            F.when(
                address.rlike(IPV4_TAIL),
                F.concat(
                    F.regexp_extract(address, IPV4_TAIL, 1), _hex_pair(address, 2), F.lit(":"), _hex_pair(address, 4)
                ),
            ).otherwise(address),
        )
        .withColumn(
            name("plain"), F.lower(F.regexp_replace(expanded, "(?<![0-9A-Fa-f])0+(?=[0-9A-Fa-f])", ""))
        )
        .withColumn(
            out,
            F.when(F.col(text).rlike(IPV4), F.col(text)).when(
                (scope == "") | scope.rlike(r"(?s)^%[^%]+\z"), F.concat(shown, scope)
            ),
        )
        .drop(*[name(n) for n in ("v6", "address", "scope", "hextets", "plain")])
    )
