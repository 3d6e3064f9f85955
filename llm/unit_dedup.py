"""Substring dedup by hashing paragraphs, lines, or the sentences in lines.

Texts are cut into units: at blank lines (`paragraph`), at line ends (`line`), or at line ends and after the marks that
end a sentence (`sentence`, so that a passage set into the middle of a line is found too). A unit is normalised: lower
case, and runs of other characters than letters and digits as one space. Units of at least `min_words` words (two letters
of a script written without blanks count as one) are hashed, the digests are grouped over all documents, and the earliest
occurrence stays; the rest is removed from the text, and its places in the original text are returned.

With `min_chars`, whole paragraphs and lines of at least so many normalised characters are units too, so that a repeated
one goes as a whole, whatever it is cut into. A unit with the words of one around it is the same unit. What is removed
inside another removed unit isn't returned on its own.

Occurrences are ranked by doc_id (null last), then by the text's hash, then by place. Rows equal in doc_id and text are
one document. Texts are cut and hashed in tasks of their own; only digests and places are shuffled, digests that occur
once drop out there, and a digest of many documents is counted before it meets its occurrences. Null texts stay null; a
text without a long enough unit stays whole. Other columns pass through untouched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from llm.batches import map_texts
from llm.columns import set_aside
from llm.tables import stage

#: Marks that end a sentence whether or not a blank follows.
_ENDS = "\u3002\uff01\uff1f\uff61\u0964\u061f"
#: A unit with what ends it.
UNITS = {
    "paragraph": re.compile(r".+?(?:\n[ \t\r]*\n+|\Z)", re.DOTALL),
    "line": re.compile(r"[^\n]*\n|[^\n]+"),
    "sentence": re.compile(rf"[^\n.!?{_ENDS}]*(?:[.!?]+(?![\s.!?{_ENDS}])[^\n.!?{_ENDS}]*)*(?:[.!?{_ENDS}]+[ \t]*|\n|\Z)"),
}
_WORDS = re.compile(r"[^\W_]+")
#: Letters of scripts written without blanks: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")


def _enough(part: str, words: list[str], min_words: int) -> bool:
    return len(words) >= min_words or not part.isascii() and bool(words) and len(_UNSPACED.findall(part)) >= 2 * min_words


def _place(text: str, start: int, end: int) -> tuple[int, int]:
    part = text[start:end]
    start += len(part) - len(part.lstrip())
    return start, start + len(part.strip())


def units(text: str, kind: str, min_words: int) -> list[tuple[int, int, int]]:
    """start, end and digest of each unit with enough words; places leave out blanks around it."""
    out = []
    for found in UNITS[kind].finditer(text):
        part = found[0]
        words = _WORDS.findall(part.lower())
        if _enough(part, words, min_words):
            out.append((*_place(text, *found.span()), xxhash.xxh3_64_intdigest(" ".join(words))))
    return out


def nested_units(text: str, kind: str, min_words: int, min_chars: int) -> list[tuple[int, int, int]]:
    """The units of a kind, and the whole paragraphs and lines around them."""
    out = []

    def add(start: int, end: int, words: str) -> None:
        out.append((*_place(text, start, end), xxhash.xxh3_64_intdigest(words)))

    for paragraph in UNITS["paragraph"].finditer(text):
        lines = []
        for line in UNITS["line"].finditer(text, *paragraph.span()):
            cut = [line] if kind != "sentence" else UNITS["sentence"].finditer(text, *line.span())
            parts = [(part, words) for part in cut if (words := _WORDS.findall(part[0].lower()))]
            if parts:
                lines.append((line, " ".join(" ".join(words) for _, words in parts), parts))
        whole = " ".join(words for _, words, _ in lines)
        if len(whole) >= min_chars:
            add(*paragraph.span(), whole)
        for line, line_words, parts in lines:
            if len(line_words) >= min_chars and line_words != whole:
                add(*line.span(), line_words)
            for part, words in parts if kind == "sentence" else ():
                joined = " ".join(words)
                if _enough(part[0], words, min_words) and (len(joined) < min_chars or joined not in (line_words, whole)):
                    add(*part.span(), joined)
    return out


def occurrences(docs: DataFrame, kind: str, min_words: int, min_chars: int | None = None) -> DataFrame:
    """doc_id, text_hash, start, end, digest of each unit that is long enough."""
    cut = (lambda t: units(t, kind, min_words)) if min_chars is None else (lambda t: nested_units(t, kind, min_words, min_chars))

    def block(texts: list[str | None], rows: pa.RecordBatch) -> dict | None:
        found = [cut(t) if t else [] for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in found])
        if not len(owner):
            return None
        start, end, digest = (np.array(x) for x in zip(*[u for x in found for u in x]))
        take = pa.array(owner)
        return {
            "doc_id": rows.column("doc_id").take(take),
            "text_hash": rows.column("text_hash").take(take),
            "start": start.astype(np.int32),
            "end": end.astype(np.int32),
            "digest": digest.astype(np.uint64).view(np.int64),
        }

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return map_texts(rows, block, "doc_id long, text_hash long, start int, end int, digest long")


def repeats(docs: DataFrame, kind: str = "sentence", min_words: int = 8, min_chars: int | None = None) -> DataFrame:
    """doc_id, text_hash and `spans` (start, end) of the units that occur earlier, for documents that have some."""
    every = stage(occurrences(docs, kind, min_words, min_chars), "units")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "start")
    first = every.groupBy("digest").agg(F.min(order).alias("first"), F.max(order).alias("end_")).where(F.col("first") != F.col("end_"))
    first = stage(first.select("digest", "first"), "repeated-units")
    later = every.join(first, "digest").where(order != F.col("first"))
    # units stand in one another or apart: one that ends within an earlier one is in it
    before = W.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end")).rowsBetween(W.unboundedPreceding, -1)
    outer = later.withColumn("held", F.max("end").over(before)).where("held is null or end > held")
    return outer.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def dedup_units(docs: DataFrame, kind: str = "sentence", min_words: int = 8, min_chars: int | None = None) -> DataFrame:
    """`docs` with the repeats removed from `text`; adds n_removed, removed_chars and removed_spans (`start-end`, ...), before
    which columns of these names give way; all others, whatever their names, stay."""
    docs, back = set_aside(docs, ["doc_id", "text"], ["n_removed", "removed_chars", "removed_spans"], ("text",))
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    cut = repeats(docs, kind, min_words, min_chars).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of"), "spans")
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length("text")))
    kept = F.array_join(F.zip_with(ends, starts, lambda a, b: F.substr("text", a + 1, b - a)), "")
    found = joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "text"],
        F.when(F.size(spans) == 0, F.col("text")).otherwise(kept).alias("text"),
        F.size(spans).cast("long").alias("n_removed"),
        F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long").alias("removed_chars"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed_spans"),
    )
    return back(found)
