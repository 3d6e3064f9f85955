"""Best-fit packing of token sequences, in bulk-synchronous steps.

Documents are encoded, and those longer than a sequence are cut into whole sequences and a rest. Lengths are whole
numbers from 1 to the capacity, so documents and gaps are range-sorted by counting: one Spark job gives the number of
pieces of each length, and each piece gets its rank among those of its length. A step then takes the longest length not
yet packed, all its pieces at once, and sweeps from the smallest gap that holds it upwards (the successor); pieces and
gaps meet by rank, so that no two pieces want one place; the gaps shrink, and the next length follows. Sequences with
equal gaps are interchangeable, so a step deals with ranges of them: its work depends on the capacity, never on the
number of documents. What the steps yield, a place for each range of ranks, is joined to the pieces.

Null texts count as empty: one piece that holds the end id alone. Repeated rows are packed each on its own, null ids
like others. An empty table gives an empty result.
"""

from __future__ import annotations

import array
import bisect
import functools
import itertools
import json
import os
import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, Window as W

from llm.batches import bound_batches, give_back
from llm.tables import stage
from llm.wordhash import blocks

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
_PLACES = "length long, first_rank long, n long, first_sequence long, per_sequence long, first_offset long"
#: Distinct words whose ids are remembered from block to block, some 50 MB; beyond that the last block's words stay.
_WORDS = 250_000
#: The split pattern of word-end vocabularies, and the same for plain texts: ASCII, Latin letters that neither normal
#: forms nor lower case join or split.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\xff\u0152\u0153]*")
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff\u0153]+|[0-9]|[^\t-\r 0-9a-z\xdf-\xf6\xf8-\xff\u0153]+")


class WordEncoder:
    """Ids of texts by a tokenizer that lower-cases and drops white space, as little-endian 32-bit values.

    Such a tokenizer merges within words (runs of letters, single digits, runs of signs) only. Texts of plain Latin
    characters are split into these words here, the ids of frequent words are remembered, and new words go to the
    tokenizer's merges alone. Other texts are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        setting = json.loads(self.tokenizer.to_str())
        self.mark = mark = setting["model"]["end_of_word_suffix"] or ""
        self.special = [x["content"] for x in setting["added_tokens"]]
        steps = setting["pre_tokenizer"].get("pretokenizers", [])
        pattern = "".join(x["pattern"]["Regex"] for x in steps if x["type"] == "Split")
        #: Whether words may be encoded apart: only for the pattern that _WORD restates, with word ends marked, and bytes
        #: as letters in between.
        self.by_word = bool(mark) and pattern == _PATTERN and [x["type"] for x in steps] == ["Split", "ByteLevel"] and setting["model"]["type"] == "BPE"
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: letters.pre_tokenize_str(chr(i))[0][0] for i in [*range(0x80, 0x100), 0x153]}
        self.known: dict[str, bytes] = {}

    def learn(self, words: Iterable[str]) -> None:
        merge, letters = self.tokenizer.model.tokenize, self.letters
        for word in words:
            tokens = merge(word if word.isascii() else word.translate(letters))
            self.known[word] = array.array("I", [t.id for t in tokens]).tobytes() if sys.byteorder == "little" else self.whole(word)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        words: list[list[str] | None] = []
        for t in texts:
            plain = self.by_word and _PLAIN.fullmatch(t or "") and not any(x in t for x in self.special if t)
            words.append(_WORD.findall(t.lower() if t else "") if plain else None)
        used = set(itertools.chain.from_iterable(filter(None, words)))
        if len(self.known) > _WORDS:
            self.known = {w: self.known[w] for w in used if w in self.known}
        if new := used.difference(self.known):
            self.learn(new)
        known = self.known
        return [self.whole(t) if ws is None else b"".join(map(known.__getitem__, ws)) for t, ws in zip(texts, words)]


@functools.cache
def encoder(path: str) -> WordEncoder:
    """This process's encoder, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


@dataclass(frozen=True)
class Packing:
    """tokenizer: path of a tokenizers file, the same on all machines; capacity: tokens of a sequence; end: id put after
    each document; with_ids: whether pieces carry their ids (little-endian 32 bits) in column `ids`."""

    tokenizer: str
    capacity: int = 4096
    end: int = 1
    with_ids: bool = False


def cut_pieces(docs: DataFrame, how: Packing) -> DataFrame:
    """The pieces of each document, with their rank among those of the same length in the same task (`part`)."""
    schema = PIECES + (", ids binary" if how.with_ids else "")
    width = 4 * how.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = encoder(how.tokenizer), how.end.to_bytes(4, "little"), TaskContext.get().partitionId()
        seen = [0] * (how.capacity + 1)
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for first, last in blocks(texts):
                rows = []
                for doc_id, data in zip(ids[first:last], encode(texts[first:last])):
                    data += end
                    for at in range(0, len(data), width):
                        piece = data[at : at + width]
                        n = len(piece) // 4
                        rows.append((doc_id, at // width, at // 4, n, zlib.crc32(piece), part, seen[n], *[piece] * how.with_ids))
                        seen[n] += 1
                columns = [pa.array(x, type=t) for x, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for `counts[length]` pieces of each length: rows as in _PLACES.

    Of the pieces of a length, those ranked first_rank to first_rank + n - 1 go to the sequences from first_sequence on,
    per_sequence to each, the first at first_offset.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: ranges (first sequence, how many)
    sizes: list[int] = []  # the gaps that exist, ascending
    out, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):  # no gap holds it: new sequences
                add(capacity, opened, -(-left // (capacity // length)))
                opened += -(-left // (capacity // length))
                at = bisect.bisect_left(sizes, length)
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            each = gap // length
            whole = min(n, left // each)
            if whole:
                out.append((length, rank, whole * each, first, each, capacity - gap))
                add(gap - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            rest = n - whole
            if rest and left and left < each:
                out.append((length, rank, left, first + whole, left, capacity - gap))
                add(gap - left * length, first + whole, 1)
                add(gap, first + whole + 1, rest - 1)
                left = 0
            elif rest:
                add(gap, first + whole, rest)
    return out


def pack(docs: DataFrame, how: Packing) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for)."""
    spark = docs.sparkSession
    pieces = stage(cut_pieces(docs, how), "pieces")
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    parts = stage(parts.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")), "piece-counts")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = spark.createDataFrame(best_fit(counts, how.capacity), _PLACES)  # as many at most as lengths and gaps allow
    ranked = pieces.join(parts.select("length", "part", "before"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    nth = F.col("rank") - F.col("first_rank")
    inside = (nth >= 0) & (nth < F.col("n"))
    return (
        ranked.join(F.broadcast(places.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & inside)
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(nth / F.col("per_sequence")))
        .withColumn("offset", F.col("first_offset") + nth % F.col("per_sequence") * F.col("length"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * how.with_ids)
    )
