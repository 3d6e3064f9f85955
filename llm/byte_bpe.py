"""Byte-level BPE encoding and decoding in Arrow batches, and the same merges with Spark's higher-order functions.

A task splits its texts by the vocabulary's pattern. The bytes of a word are folded by rank: the pair of neighbours whose union has
the least rank, the leftmost of those, becomes one piece, until no union has a rank. Pairs wait in a heap, so that a long word
takes little more than time in proportion. Words met lately are remembered with their ids, a bounded number in each task;
nothing is counted first, no row is moved, and plans hold no vocabulary. Decoding joins the pieces of the ids.

For columns of words there are `merged_ids` and `encode_words`, which are expressions alone: a fold over arrays of ids with the
ranks of all neighbours' unions, and over text, its bytes in brackets, `<61><62>`, for long words. There each step replaces a pair
wherever it stands (in a vocabulary built by merges nothing with a lower rank can come of it, so this is the same as one merge
at a time). Such a fold is interpreted and takes twenty times the time of the one in batches.

Null texts count as empty and have no ids. Rows stay as they are, repeated ones and null ids too.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from llm.batches import bound_batches, give_back

#: White space as Unicode has it, spelled out: Python's \s has four control characters more.
_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
#: Words whose ids a task remembers, some 110 MB; longer ones than _LONG characters are not among them.
_WORDS = 500_000
_LONG = 64
#: Bytes of a word that is folded as arrays in expressions; a longer one as text.
_SHORT = 256
#: An odd number: numbers times this differ in their low bits if they did before.
_SPREAD = 0x9E3779B1
#: Stands for the rank of a pair that has none.
_NONE = (1 << 31) - 1


@dataclass(frozen=True)
class Vocabulary:
    """Ranks by piece (hexadecimal), and the pattern that splits texts, without groups that capture."""

    ranks: dict[str, int]
    pattern: str

    @property
    def end(self) -> int:
        """The first number that is no id."""
        return max(self.ranks.values()) + 1

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        """From a file of base64 pieces and ranks."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a).hex().upper(): int(b) for a, b in map(bytes.split, lines)}
        return Vocabulary(ranks, pattern)


def spelled_pattern(pattern: str) -> str:
    """The split pattern with white space spelled out, for engines whose \\s is another."""
    return pattern.replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


def _slot(key: Column, size: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(size)).cast("int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_map(entries: dict[str, object]) -> Callable[[Column], Column]:
    """A lookup in a literal, by hexadecimal keys; the value as text, null for other keys.

    The literal is an array of short texts `,key:value,key:value,`, which takes far less memory than maps do.
    """
    size = max(1, len(entries) // 2)
    buckets = [[""] for _ in range(size)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode()) % size].append(f"{key}:{value}")
    table = F.split(F.lit("\n".join(",".join([*b, ""]) for b in buckets)), "\n")

    def look(key: Column, bucket: Column) -> Column:
        at = F.instr(bucket, F.concat(F.lit(","), key, F.lit(":")))
        return _let(at, lambda i: F.when(i > 0, F.substring_index(F.substr(bucket, i + F.length(key) + 2), ",", 1)))

    return lambda value: _let(value, lambda key: _let(F.get(table, _slot(key, size)), lambda bucket: look(key, bucket)))


def _parts(word: Column) -> Column:
    """The pieces of `<..><..>`; a split at one plain sign needs no pattern."""
    return F.split(F.replace(F.btrim(word, F.lit("<>")), F.lit("><"), F.lit(",")), ",")


def merge(whole: Column, rank: Callable[[Column], Column]) -> Column:
    """The merged form `<..><..>` of a word given as its bytes in hexadecimal."""

    def merged(word: Column, parts: Column, ranks: Column, least: Column) -> Column:
        at = F.array_position(ranks, least).cast("int")
        a, b = F.get(parts, at - 1), F.get(parts, at)
        return F.replace(word, F.concat(F.lit("<"), a, F.lit("><"), b, F.lit(">")), F.concat(F.lit("<"), a, b, F.lit(">")))

    def ranks_of(parts: Column) -> Column:
        n = F.size(parts) - 1
        return F.zip_with(F.slice(parts, 1, n), F.slice(parts, 2, n), lambda a, b: rank(F.concat(a, b)).cast("int"))

    def step(state: Column, _: Column) -> Column:
        done = F.struct(state["word"].alias("word"), F.lit(True).alias("done"))
        following = _let(_parts(state["word"]), lambda parts: _let(ranks_of(parts), lambda ranks: _let(F.array_min(ranks), lambda least:
            F.when(least.isNull(), done).otherwise(F.struct(merged(state["word"], parts, ranks, least).alias("word"), F.lit(False).alias("done"))))))
        return F.when(state["done"], state).otherwise(following)

    start = F.struct(F.regexp_replace(whole, "(..)", "<$1>").alias("word"), (F.length(whole) <= 2).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(whole) / 2 - 1, F.lit(1)).cast("int")), start, step)["word"]


def _numbers(values: list[int], kind: str) -> Column:
    """A literal array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _power(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


def pair_ranks(vocabulary: Vocabulary) -> Callable[[Column, Column], Column]:
    """A lookup of the rank of two neighbouring ids' union; `_NONE` where it has none.

    A pair's key is one number. Its place in the literal is a hash of the key moved by the shift of the key's group, and the
    shifts are chosen so that no two pairs meet.
    """
    ranks, base = vocabulary.ranks, vocabulary.end + 1
    splits = ((piece[:i], piece[i:], rank) for piece, rank in ranks.items() for i in range(2, len(piece), 2))
    pairs = {ranks[a] * base + ranks[b]: rank for a, b, rank in splits if a in ranks and b in ranks}
    groups = _power(len(pairs) // 3)
    bits, size = groups.bit_length() - 1, _power(max(2 * len(pairs), base * base // groups + 1))  # so keys of a group never meet
    members: list[list[int]] = [[] for _ in range(groups)]
    for key in pairs:
        members[key % groups].append(key)
    shifts, keys, values = [0] * groups, [-1] * size, [_NONE] * size
    for group in sorted(range(groups), key=lambda g: -len(members[g])):
        shift, hashed = group * _SPREAD % size, [(key >> bits) * _SPREAD % size for key in members[group]]
        while any(keys[(h + shift) % size] >= 0 for h in hashed):
            shift = (shift + 1) % size
        shifts[group] = shift
        for key, h in zip(members[group], hashed):
            keys[(h + shift) % size], values[(h + shift) % size] = key, pairs[key]
    shift_of, key_at, value_at = _numbers(shifts, "int"), _numbers(keys, "bigint"), _numbers(values, "int")

    def place(key: Column) -> Column:
        shift = F.get(shift_of, key.bitwiseAND(F.lit(groups - 1).cast("bigint")).cast("int"))
        return (F.shiftright(key, bits) * F.lit(_SPREAD) + shift).bitwiseAND(F.lit(size - 1).cast("bigint")).cast("int")

    def look(key: Column) -> Column:
        return _let(place(key), lambda at: F.when(F.get(key_at, at) == key, F.get(value_at, at)).otherwise(_NONE))

    return lambda a, b: _let(a.cast("bigint") * base + b, look)


def merged_ids(whole: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word given as its bytes in hexadecimal; `end` stands on both sides of a word, so that no place is special."""
    pair, end = pair_ranks(vocabulary), F.lit(vocabulary.end)
    of_byte = _numbers([vocabulary.ranks.get(f"{byte:02X}", vocabulary.end) for byte in range(256)], "int")
    size = F.lit(4 * _SHORT)

    def merged(state: Column, least: Column, at: Column) -> Column:
        ids, ranks = state["ids"], state["ranks"]
        beside = F.transform(F.array(F.struct(F.get(ids, at - 2).alias("a"), least.alias("b")), F.struct(least.alias("a"), F.get(ids, at + 1).alias("b"))), lambda x: pair(x["a"], x["b"]))
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), at - 1), F.array(least), F.slice(ids, at + 2, size)).alias("ids"),
            F.concat(F.slice(ranks, F.lit(1), at - 2), beside, F.slice(ranks, at + 2, size)).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        following = lambda least: _let(F.array_position(state["ranks"], least).cast("int"), lambda at: merged(state, least, at))
        return _let(F.array_min(state["ranks"]), lambda least: F.when(least == _NONE, state).otherwise(following(least)))

    bytes_ = F.transform(F.regexp_extract_all(whole, F.lit(".."), F.lit(0)), lambda d: F.get(of_byte, F.conv(d, 16, 10).cast("int")))
    ranked = lambda ids: F.struct(ids.alias("ids"), F.zip_with(F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids) - 1), pair).alias("ranks"))
    start = _let(F.concat(F.array(end), bytes_, F.array(end)), ranked)
    steps = F.sequence(F.lit(1), F.greatest(F.length(whole) / 2 - 1, F.lit(1)).cast("int"))
    return F.aggregate(steps, start, step, lambda state: F.slice(state["ids"], F.lit(2), F.size(state["ids"]) - 2))


def _little(number: int) -> str:
    """An id as eight hexadecimal digits, least byte first."""
    return number.to_bytes(4, "little").hex().upper()


def encode_words(words: Column, vocabulary: Vocabulary, known: Callable[[Column], Column] | None = None, long_ones: bool = True) -> Column:
    """The ids of each of an array of words, eight digits each; `known` has those of some words.

    Each step is a transform of its own, as an expression used twice in one would be computed twice.
    """
    none = F.lit(None).cast("string")
    digits = ["" for _ in range(vocabulary.end)]
    for number in vocabulary.ranks.values():
        digits[number] = _little(number)
    table = F.split(F.lit(",".join(digits)), ",")
    shown = lambda ids: F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    bytes_ = F.transform(words, lambda w: F.hex(F.encode(w, "UTF-8")))
    found = F.transform(bytes_, lambda w: F.struct((known(w) if known else none).alias("ids"), w.alias("word")))
    rank, short = literal_map(vocabulary.ranks), lambda w: merged_ids(w, vocabulary)
    as_text = lambda w: F.transform(_parts(merge(w, rank)), lambda p: rank(p).cast("int"))
    folded = (lambda w: F.when(F.length(w) <= 2 * _SHORT, short(w)).otherwise(as_text(w))) if long_ones else short
    return F.transform(found, lambda x: F.coalesce(x["ids"], shown(folded(x["word"]))))


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the leftmost pair of least rank is merged until no pair has a rank.

    A piece is known by its first place; `end` has where it ends (0: it's part of one before it), `before` where the one before begins.
    """
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapify(pairs)
    while pairs:
        _, start, stop = heappop(pairs)
        middle = end[start]
        if not middle or middle == n or end[middle] != stop:  # one of the two has been merged since
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
            if (rank := ranks.get(word[start : end[stop]])) is not None:
                heappush(pairs, (rank, start, end[stop]))
        if (first := before[start]) >= 0 and (rank := ranks.get(word[first:stop])) is not None:
            heappush(pairs, (rank, first, stop))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


class Words(dict):
    """Ids by word, as little-endian 32-bit values; of the words met lately at most `most` stay."""

    def __init__(self, ranks: dict[bytes, int], most: int):
        super().__init__()
        self.ranks, self.half, self.older = ranks, max(1, most // 2), {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            raw = word.encode()
            numbers = [self.ranks[raw]] if raw in self.ranks else fold(raw, self.ranks)
            ids = struct.pack(f"<{len(numbers)}I", *numbers)
        if len(word) <= _LONG:
            if len(self) >= self.half:
                self.older = self.copy()
                self.clear()
            self[word] = ids
        return ids


def encode(docs: DataFrame, vocabulary: Vocabulary, most: int = _WORDS) -> DataFrame:
    """`docs` with `ids`: binary, little-endian 32-bit ids of the whole text."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words({bytes.fromhex(piece): rank for piece, rank in vocabulary.ranks.items()}, most)
        split, ids_of = regex.compile(spelled_pattern(vocabulary.pattern)).findall, words.__getitem__
        for texts in batches:
            yield pa.array((b"".join(map(ids_of, split(text.as_py() or ""))) for text in texts), pa.binary())
        words.older = {}
        words.clear()
        give_back()

    return docs.withColumn("ids", encoded("text"))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of ids given as little-endian 32-bit values; null for null."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        piece = defaultdict(bytes, {rank: bytes.fromhex(piece) for piece, rank in vocabulary.ranks.items()}).__getitem__
        for rows in batches:
            values = (row.as_py() for row in rows)
            yield pa.array((None if x is None else b"".join(map(piece, np.frombuffer(x, "<u4").tolist())) for x in values), pa.binary())
        give_back()

    return decoded(ids)
