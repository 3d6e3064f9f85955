"""Line dedup by windows of line hashes, pre-filtered by winnowing, with DataFrame functions only.

The lines that hold a word, trimmed, are hashed. Of each window of `run` such lines in a row the least hash (the last of
equal ones) is a fingerprint, so wherever `run` lines occur again, a fingerprint at the same place among them does too.
Fingerprints of all documents are counted and only pre-filter: windows whose fingerprint occurs at one place drop out, the
others are grouped directly, by a hash of the whole window. Each window's earliest place stays. The
lines of all later places, joined to runs, are deleted; the text's other lines, blank ones too, stay as they are.

With `words`, content counts beside the number of lines: fewer lines in a row that hold so many words together are a
window too, and so is the whole of a text with fewer than `run` lines. A letter of a script written without blanks counts
as a word there.

Places are ordered by doc_id (null last), then the text's hash, then the line. Rows equal in doc_id and text are one
document: what goes from one goes from all. A place that overlaps the earliest one in the same document stays. Null
texts stay null, empty and short ones stay whole. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from llm.columns import set_aside
from llm.tables import stage

_BLANKS = " \t\n\x0b\x0c\r"
_KEY = ["doc_id", "text_hash"]
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_WORD = rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+"


def _lines(text: Column, words: int | None = None) -> Column:
    """The lines with a word: their number in the text, the hash of what is left when trimmed, and its words if they count."""
    counted = lambda x: [] if words is None else [F.regexp_count(x["text"], F.lit(_WORD)).alias("words")]
    every = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(_BLANKS)).alias("text")))
    return F.transform(F.filter(every, lambda x: x["text"] != ""), lambda x: F.struct(x["line"].alias("line"), F.xxhash64(x["text"]).alias("hash"), *counted(x)))


def _windows(lines: Column, run: int, words: int | None = None) -> Column:
    """For each window: its first line's place, its fingerprint, that line's place, and a hash of the whole window."""

    def window(at: Column, size: int) -> Column:
        hashes = F.transform(F.slice(lines, at + 1, size), lambda x: x["hash"])
        least = F.array_min(hashes)
        last = size - F.array_position(F.reverse(hashes), least).cast("int")
        return F.struct(at.alias("at"), F.lit(size).alias("size"), least.alias("fingerprint"), (at + last).alias("place"), F.xxhash64(hashes).alias("window"))

    def enough(at: Column, size: int) -> Column:
        held = F.aggregate(F.slice(lines, at + 1, size), F.lit(0), lambda n, x: n + x["words"])
        return (held >= words) | (F.size(lines) == size)

    def of(size: int) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - size)
        if size < run:
            places = F.filter(places, lambda at: enough(at, size))
        return F.when(F.size(lines) >= size, F.transform(places, lambda at: window(at, size))).otherwise(F.array())

    return of(run) if words is None else F.concat(*[of(size) for size in range(1, run + 1)])


def repeated_lines(docs: DataFrame, run: int = 3, words: int | None = None) -> DataFrame:
    """doc_id, text_hash and `removed`: the numbers of the lines (from 0) of each document that are later repeats."""
    keyed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), _lines(F.col("text"), words).alias("lines"))
    exploded = keyed.select(*_KEY, F.col("lines.line").alias("numbers"), F.explode(_windows(F.col("lines"), run, words)).alias("w"))
    windows = exploded.select(*_KEY, "w.at", "w.fingerprint", "w.place", "w.window", F.slice("numbers", F.col("w.at") + 1, F.col("w.size")).alias("numbers"))
    windows = stage(windows, "windows")
    chosen = windows.groupBy("fingerprint", *_KEY, "place").agg(F.lit(1).alias("one")).groupBy("fingerprint").agg(F.count("*").alias("n"))
    again = stage(chosen.where("n > 1").select("fingerprint"), "fingerprints")
    near = stage(windows.join(again, "fingerprint").drop("fingerprint", "place"), "matches")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "at")
    first = near.groupBy("window").agg(F.min(order).alias("first"), F.max(order).alias("end")).where(F.col("first") != F.col("end"))
    first = stage(first.select("window", "first"), "earliest")
    same = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.hash"))
    later = near.join(first, "window").where(~(same & (F.col("at") < F.col("first.at") + F.size("numbers"))))
    return later.groupBy(*_KEY).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("numbers")))).alias("removed"))


def _runs(removed: Column) -> Column:
    """Line numbers as `start-end` of each run (end exclusive), comma-joined."""
    starts = F.array_except(removed, F.transform(removed, lambda x: x + 1))
    ends = F.array_except(removed, F.transform(removed, lambda x: x - 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.concat_ws("-", a.cast("string"), (b + 1).cast("string"))), ",")


def dedup_lines(docs: DataFrame, run: int = 3, words: int | None = None) -> DataFrame:
    """`docs` with the later repeats deleted from `text`; adds n_lines, n_removed and removed_runs, before which columns of
    these names give way; all others, whatever their names, stay."""
    docs, back = set_aside(docs, ["doc_id", "text"], ["n_lines", "n_removed", "removed_runs"], ("text",))
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    cut = repeated_lines(docs, run, words).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of"), "removed")
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")), "left")
    lines, removed = F.split("text", "\n"), F.coalesce("removed", F.array().cast("array<int>"))
    # bound as a lambda's variable, the lines are split once and not once for each of them
    kept = F.transform(F.array(lines), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), removed), lambda i: F.get(x, i)))
    text = F.when(F.size(removed) == 0, F.col("text")).otherwise(F.array_join(F.get(kept, F.lit(0)), "\n"))
    columns = [c for c in docs.columns if c != "text"]
    found = joined.select(
        *[F.col(f"`{c}`") for c in columns],
        text.alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        _runs(removed).alias("removed_runs"),
    )
    return back(found)


#: The same rows for tables without null or repeated ids, and without `words`.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, t.line - 1 AS line, t.raw, trim(t.raw, E' \t\n\x0b\x0c\r') AS body
  FROM documents, LATERAL (SELECT unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line) t
  WHERE text IS NOT NULL
), worded AS (
  SELECT doc_id, line, body, row_number() OVER w - 1 AS place, lead(line, 1) OVER w AS line1, lead(body, 1) OVER w AS body1,
         lead(line, 2) OVER w AS line2, lead(body, 2) OVER w AS body2
  FROM lines WHERE body <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY line)
), ranked AS (
  SELECT *, first_value(doc_id) OVER g AS first_id, first_value(place) OVER g AS first_place
  FROM worded WHERE line2 IS NOT NULL
  WINDOW g AS (PARTITION BY body, body1, body2 ORDER BY doc_id, place)
), later AS (
  SELECT * FROM ranked WHERE doc_id <> first_id OR place >= first_place + 3
), gone AS (
  SELECT doc_id, line FROM later UNION SELECT doc_id, line1 FROM later UNION SELECT doc_id, line2 FROM later
), islands AS (
  SELECT doc_id, min(line) AS a, max(line) + 1 AS b
  FROM (SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS island FROM gone) GROUP BY doc_id, island
), runs AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed_runs FROM islands GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
         coalesce(string_agg(l.raw, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id
)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, coalesce(r.removed_runs, '') AS removed_runs
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN runs r USING (doc_id)
"""
