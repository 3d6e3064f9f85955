"""Personal data by candidate gradient boosting, with DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers exactly. Beside them, generators of high recall
propose spans that may overlap: values assigned to a telling name, long tokens of letters and digits, groups of digits,
anything around an at sign. Each candidate gets features of its format and its context, all small whole numbers. The
candidates of all documents are counted by their features (the number of cells is bounded by the features, not by the
corpus); a candidate counts as right if a strict format or its context confirms it: assigned values by the kinds of
characters in them, tokens by well-known forms, groups of digits by a plus sign, a telling word or Luhn's check, addresses
by the base rule. What confirms them by the base rules, the plus sign and plain ASCII, is no feature, so numbers and
addresses of the same form without it are found too; addresses beyond ASCII aren't learned from. Boosted trees are grown
on the cells of each generator, its threshold is set on its cells of the documents left out, so that what is selected
there is right in `precision` of cases, and the trees become one SQL expression. Accepted candidates that no base span
overlaps are added.

Places are code points, ends exclusive. Null texts count as empty. Rows stay as they are, repeated ones, null ids and
other columns included; a text is searched whole.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: Base rules, in the order in which kinds are listed. Possessive loops and the look-behinds find the same matches in
#: linear time: a match starts where its run of characters does, or where the match before it ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)" + _EMAIL,
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "secret"]
#: What a text needs for a rule to be worth a search.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_NAMES = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key)"
#: A match runs to the end of its characters, however long; it starts where they do, so that a search takes linear time.
GENERATORS = {
    "assigned": r"(?i)(?<![A-Za-z])" + _NAMES + r"\x20?[:=]\x20?[\"']?[^\s\"',;]{6,}+",
    "token": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+",
    "digits": r"(?<![0-9])[0-9]{3,4}(?:[\x20.-][0-9]{2,7}){1,4}(?![0-9])",
    "address": r"(?<![^\s<(])[^\s@<>()]++@[^\s@<>()]++",
}
_GENERATOR_HINTS = {"assigned": r"(?i)" + _NAMES + r"\x20?[:=]", "token": r"[A-Za-z0-9_-]{16}", "digits": r"[0-9]{3}[\x20.-][0-9]", "address": "@"}
#: Words before a number of a person; a date's form.
_TELLING = (
    r"(?:phone|t[eé]l[eé]fono?|t[eé]l[eé]phone|\btel\b|mobile?|\bhandy|\bm[oó]vil|\bcall\b|\bfax\b|\bssn\b|social security|security n"
    r"|passport|passeport|pasaporte|reisepass|\biban\b)[^0-9\n]*$"
)
#: An address with the letters of any script.
_DOMAIN = r"^\W*[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+[^\p{L}\p{N}]*$"
_DATE = r"^(?:19|20)[0-9]{2}[.\x20-](?:0?[1-9]|1[0-2])[.\x20-][0-3]?[0-9](?![0-9])"
FEATURES = ["generator", "length", "digits", "upper", "lower", "variety", "named", "quoted", "checked", "groups", "last", "telling", "kinds", "domain"]
_SPAN = "struct<kind:int,start:int,end:int>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches of a pattern, leftmost first and not overlapping: start, end, value."""

    def placed(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

        def step(state: Column, part: Column) -> Column:
            return _let(
                F.struct((state["at"] + F.length(part["before"])).alias("start"), part["value"].alias("value"), state["out"].alias("out")),
                lambda x: F.struct(
                    (x["start"] + F.length(x["value"])).alias("at"),
                    F.concat(x["out"], F.array(F.struct(x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))).alias("out"),
                ),
            )

        return F.aggregate(parts, start, step)["out"]

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    parts = F.zip_with(F.slice(between, 1, F.size(between) - 1), found, lambda a, b: F.struct(a.alias("before"), b.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(hint), F.when(F.size(found) > 0, placed(parts)).otherwise(none)).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass Luhn's check."""

    def worth(digit: Column, i: Column) -> Column:
        twice = F.coalesce(digit.try_cast("int"), F.lit(0)) * (1 + i % 2)
        return twice - F.when(twice > 9, 9).otherwise(0)

    reversed_ = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d)
    return F.aggregate(F.transform(reversed_, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda x: _let(F.ltrim(x, F.lit("0")), lambda y: (F.length(y) <= 3) & (F.coalesce(y.try_cast("int"), F.lit(0)) <= 255)))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The spans of the base rules: kind (its place in KINDS), start, end; ordered by start, then kind."""
    kinds = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        good = F.filter(matches(text, pattern, _HINTS[kind]), lambda m: _holds(kind, m["value"]))  # noqa: B023
        kinds.append(F.transform(good, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))))  # noqa: B023
    return _ordered(F.concat(*kinds))


def _ordered(spans: Column) -> Column:
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.transform(by_start, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(text: Column) -> Column:
    """The proposals of all generators, each with its features and whether it is confirmed (null: can't be told)."""
    every = []
    for i, (name, pattern) in enumerate(GENERATORS.items()):
        found = matches(text, pattern, _GENERATOR_HINTS[name])
        before = lambda m: F.lower(F.substring(F.substr(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24))), 1, 24))
        every.append(F.transform(found, lambda m: F.struct(F.lit(i).alias("generator"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), before(m).alias("before"))))  # noqa: B023

    def describe(c: Column) -> Column:
        value, size = c["value"], F.length(c["value"])
        digits = F.length(_digits(value))
        payload = F.regexp_extract(value, r"[:=]\x20?[\"']?(.*)", 1)
        kinds = sum((payload.rlike(x).cast("int") for x in ("[0-9]", r"\p{Ll}.*\p{Lu}", "[!#$%&*+=?@^~|]")), F.lit(0))
        number = (c["generator"] == 2) & digits.between(7, 15) & ~value.rlike(_DATE)
        telling = number & c["before"].rlike(_TELLING)
        strict = (
            F.when(c["generator"] == 0, kinds > 0)
            .when(c["generator"] == 1, value.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$|^(?:ghp|gho|ghs)_[A-Za-z0-9]{30,}$|^sk-[A-Za-z0-9]{20,}$"))
            .when(c["generator"] == 2, telling | (number & c["before"].rlike(r"\+[0-9][\x20().0-9-]*$")) | (luhn(value) & (digits >= 14)))
            .when(value.rlike(r"^\p{ASCII}*$"), value.rlike(r"^\W*" + _EMAIL + r"\W*$"))
        )
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["generator"].alias("generator"),
            F.least(F.floor(size / 4), F.lit(12)).cast("int").alias("length"),
            F.floor(digits * 8 / size).cast("int").alias("digits"),
            F.least(F.floor(F.length(F.regexp_replace(value, r"\P{Lu}", "")) * 8 / size), F.lit(8)).cast("int").alias("upper"),
            F.least(F.floor(F.length(F.regexp_replace(value, r"\P{Ll}", "")) * 8 / size), F.lit(8)).cast("int").alias("lower"),
            F.least(F.size(F.array_distinct(F.split(value, ""))), F.lit(20)).alias("variety"),
            (F.concat(c["before"], F.lower(value)).rlike(_NAMES)).cast("int").alias("named"),
            (c["before"].rlike("[\"':=]\\s?$") | value.rlike("[:=]")).cast("int").alias("quoted"),
            (luhn(value) & (digits >= 14)).cast("int").alias("checked"),
            F.when(c["generator"] == 2, F.size(F.split(value, "[^0-9]"))).otherwise(0).alias("groups"),
            F.when(c["generator"] == 2, F.length(F.regexp_extract(value, "[0-9]+$", 0))).otherwise(0).alias("last"),
            telling.cast("int").alias("telling"),
            F.when(c["generator"] == 0, kinds).otherwise(0).alias("kinds"),
            ((c["generator"] == 3) & value.rlike(_DOMAIN)).cast("int").alias("domain"),
            strict.cast("int").alias("right"),
        )

    return F.transform(F.concat(*every), describe)


@dataclass(frozen=True)
class Boosting:
    rounds: int = 25
    rate: float = 0.3
    precision: float = 0.98


@dataclass(frozen=True)
class Trees:
    """Trees of depth two, each ((feature, limit), (feature, limit, low, high) for its left and right), and a threshold."""

    start: float
    trees: tuple
    threshold: float


def _split(cells: list, gradient: list[float], weight: list[float]) -> tuple:
    """The best (feature, limit), and the values of its two leaves."""
    best = (-1.0, FEATURES[0], -1, 0.0, 0.0)
    total_g, total_w = sum(gradient), sum(weight)
    for k, name in enumerate(FEATURES):
        low: dict[int, list[float]] = {}
        for cell, g, w in zip(cells, gradient, weight):
            entry = low.setdefault(cell[0][k], [0.0, 0.0])
            entry[0] += g
            entry[1] += w
        g = w = 0.0
        for limit in sorted(low):
            g, w = g + low[limit][0], w + low[limit][1]
            gain = g * g / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1)
            if gain > best[0]:
                best = (gain, name, limit, g / (w + 1), (total_g - g) / (total_w - w + 1))
    return best[1:]


def boost(cells: list[tuple[tuple[int, ...], int, int]], held_out: list[tuple[tuple[int, ...], int, int]], how: Boosting = Boosting()) -> Trees:
    """Trees for cells (features, number of candidates, of these right); the threshold from the cells held out."""
    total, right = sum(n for _, n, _ in cells), sum(r for _, _, r in cells)
    start = math.log((right + 0.5) / (total - right + 0.5)) if total else -math.inf
    if not right:
        return Trees(start, (), math.inf)
    scores, trees = [start] * len(cells), []
    for _ in range(how.rounds):
        chance = [1 / (1 + math.exp(-s)) for s in scores]
        gradient = [r - n * p for (_, n, r), p in zip(cells, chance)]
        weight = [n * p * (1 - p) for (_, n, _), p in zip(cells, chance)]
        name, limit, _, _ = _split(cells, gradient, weight)
        sides = []
        for left in (True, False):
            part = [i for i, c in enumerate(cells) if (c[0][FEATURES.index(name)] <= limit) == left]
            sides.append(_split([cells[i] for i in part], [gradient[i] for i in part], [weight[i] for i in part]) if part else (FEATURES[0], -1, 0.0, 0.0))
        tree = (name, limit, tuple((f, x, how.rate * a, how.rate * b) for f, x, a, b in sides))
        trees.append(tree)
        scores = [s + _leaf(tree, c[0]) for s, c in zip(scores, cells)]
    model = Trees(start, tuple(trees), math.inf)
    ranked = sorted(((start + sum(_leaf(t, f) for t in trees), n, r) for f, n, r in held_out or cells), reverse=True)
    threshold, n, r = math.inf, 0, 0
    for i, (score, here, good) in enumerate(ranked):
        n, r = n + here, r + good
        if (i + 1 == len(ranked) or ranked[i + 1][0] < score) and r >= how.precision * n:
            threshold = score
    return Trees(model.start, model.trees, threshold)


def _leaf(tree: tuple, features: tuple[int, ...]) -> float:
    name, limit, sides = tree
    f, x, low, high = sides[0 if features[FEATURES.index(name)] <= limit else 1]
    return low if features[FEATURES.index(f)] <= x else high


def _score(model: Trees, candidate: Column) -> Column:
    out = F.lit(model.start)
    for name, limit, sides in model.trees:
        leaves = [F.when(candidate[f] <= x, F.lit(low)).otherwise(F.lit(high)) for f, x, low, high in sides]
        out = out + F.when(candidate[name] <= limit, leaves[0]).otherwise(leaves[1])
    return out


def train(docs: DataFrame, how: Boosting = Boosting()) -> dict[int, Trees]:
    """Trees for each generator, from the candidates of all of `docs` (doc_id, text); every fourth document by crc32 sets the threshold."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = docs.where("text is not null").select(out.alias("out"), F.explode(candidates(F.col("text"))).alias("c")).where("c.right is not null")
    rows = found.groupBy("out", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(F.count("*").alias("n"), F.sum("c.right").alias("r")).collect()
    cells = [(r.out, tuple(r[f] for f in FEATURES), r.n, r.r) for r in sorted(rows)]
    each = {i: [c for c in cells if c[1][0] == i] for i in range(len(GENERATORS))}
    return {i: boost([c[1:] for c in own if not c[0]], [c[1:] for c in own if c[0]], how) for i, own in each.items()}


def _added(text: Column, base: Column, model: dict[int, Trees]) -> Column:
    """Accepted candidates that overlap no base span, joined where they overlap each other."""
    useful = {i: m for i, m in model.items() if m.trees and not math.isinf(m.threshold)}
    if not useful:
        return F.array().cast(f"array<{_SPAN}>")
    accepted = lambda c: [(c["generator"] == i) & (_score(m, c) >= F.lit(m.threshold - 1e-9)) for i, m in useful.items()]
    good = F.filter(candidates(text), lambda c: functools.reduce(Column.__or__, accepted(c)))
    free = F.filter(good, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    ordered = F.array_sort(F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def join(done: Column, span: Column) -> Column:
        return _let(
            F.struct(F.try_element_at(done, F.lit(-1)).alias("last"), done.alias("done"), span.alias("span")),
            lambda x: F.when(
                F.coalesce(x["last"]["end"] > x["span"]["start"], F.lit(False)),
                F.concat(
                    F.slice(x["done"], 1, F.size(x["done"]) - 1),
                    F.array(F.struct(x["last"]["start"].alias("start"), F.greatest(x["last"]["end"], x["span"]["end"]).alias("end"))),
                ),
            ).otherwise(F.concat(x["done"], F.array(x["span"]))),
        )

    return F.transform(F.aggregate(ordered, none, join), lambda s: F.struct(F.lit(len(KINDS) - 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


#: Where columns of the input wait whose names the spans have.
_ASIDE = {"base": "base of docs", "spans": "spans of docs"}


def find(docs: DataFrame, model: Trees | dict[int, Trees]) -> DataFrame:
    """`docs` with `base` and `spans`: the base spans, and these with the added ones; `model` for all generators or for each.

    Columns of `docs` with these names are called `base of docs` and `spans of docs` until `redact` gives them theirs back.
    """
    docs = docs.withColumnsRenamed(_ASIDE)
    model = model if isinstance(model, dict) else dict.fromkeys(range(len(GENERATORS)), model)
    out = docs.withColumn("base", base_spans(F.coalesce("text", F.lit(""))))
    return out.withColumn("spans", _ordered(F.concat("base", _added(F.coalesce("text", F.lit("")), F.col("base"), model))))


def summary(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their hash, and all spans as text."""
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(PATTERNS)],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(found: DataFrame) -> DataFrame:
    """`text` with each span replaced by its kind in square brackets; spans that overlap become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        return F.when(
            s["start"] >= state["at"],
            F.struct(F.concat(state["out"], F.array(F.concat(gap, F.get(names, s["kind"])))).alias("out"), s["end"].alias("at")),
        ).otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], s["end"]).alias("at")))

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))
    whole = _let(F.aggregate("spans", start, step), lambda x: F.concat(F.array_join(x["out"], ""), F.substr(F.col("text"), x["at"] + 1, F.length("text"))))
    return found.withColumn("text", F.when(F.size("spans") == 0, F.col("text")).otherwise(whole)).drop("base", "spans").withColumnsRenamed({aside: name for name, aside in _ASIDE.items()})
