"""Phrases whose words come together more often than apart, mined by partitioning (SON).

The corpus is dealt into a few shards, of many tasks each. A phrase that occurs `support` times in all occurs, in at least
one shard, as often as that shard's share of the words demands. So each shard is mined completely, level by level, at this
lowered support: words, then phrases of two words that are each frequent in some shard, and so on. The union of what is
frequent in a shard holds every phrase that can be frequent in all; a last pass counts these, and them alone, exactly
and by their text.

Mining counts 64-bit hashes, which are added up in each block of texts and in each task before they are shuffled; a
collision can only add a phrase to the union. The union goes to the tasks as a bitmap with a bit for a hash. Its size
follows the number of phrases and is bounded by `filter_bits`; a full bitmap lets more through to the shuffle and changes
no result. Counted phrases are joined with their parts; parts that make up a thousandth of all words (there can't be
many) are salted.

Null texts are empty, null languages `und`; repeated rows count each; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from llm.batches import bound_batches, give_back
from llm.tables import stage
from llm.wordhash import blocks, mix

#: Characters of text that are looked at together.
_BLOCK = 2 << 20
_SEGMENT = 1 << 20
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_RANDOM = np.random.default_rng(20261113).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)


@dataclass(frozen=True)
class Mining:
    """support: occurrences a phrase needs; words: of the longest phrase; redundant: percentage of a phrase's occurrences
    that, inside one longer phrase, make it drop out; top: phrases for each language; shards: parts of the corpus that are
    mined on their own (more of them lower the local support, and less is sorted out); filter_bits: bound of the bitmap."""

    support: int = 10
    words: int = 3
    redundant: int = 50
    top: int = 2000
    shards: int = 4
    filter_bits: int = 1 << 28


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            step = pow(self.base, len(self.up), 2**64)
            self.up = np.concatenate((self.up, self.up * np.uint64(step)))
            self.down = np.concatenate((self.down, self.down * np.uint64(pow(step, -1, 2**64))))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(base) for base in _BASES]


class Phrases:
    """The words of a block of texts, and hashes of the phrases that start at each.

    Words are runs of bytes other than blanks and piece ends; a phrase is a run of words in one piece of one text. The
    bytes are kept with one blank between words, so that a phrase is a slice of them.
    """

    def __init__(self, texts: list[str | None], langs: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass").lower().translate(_PLAIN) for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in raw], dtype=np.int64)
        blank = data == 32
        keep = ~blank
        keep[:1] = True
        keep[1:] |= ~blank[:-1]
        self.data = data[keep]
        ends = (np.cumsum(keep)[ends - 1]).astype(np.int64)
        gap = (self.data == 32) | (self.data == 10)
        before = np.concatenate(([True], gap[:-1]))
        self.first, self.last = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
        self.piece = np.cumsum(self.data == 10, dtype=np.int32)[self.first]
        self.names = [x if x is not None else "und" for x in langs]
        self.owner = np.searchsorted(ends, self.first, side="right")
        known = {x: i for i, x in enumerate(dict.fromkeys(self.names))}
        self.langs, self.lang = list(known), np.array([known[x] for x in self.names], dtype=np.int32)[self.owner]
        self.salt = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in self.langs], dtype=np.uint64)

    def _sums(self, which: int) -> np.ndarray:
        up, _ = _POWERS[which].of(len(self.data) + 1)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_RANDOM[which][self.data] * up[:-1], dtype=np.uint64)))

    def starts(self, n: int) -> np.ndarray:
        """Places of the words at which a phrase of n words starts."""
        m = max(len(self.first) - n + 1, 0)
        return np.flatnonzero(self.piece[:m] == self.piece[n - 1 : n - 1 + m])

    def hashes(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        if not hasattr(self, f"sums{which}"):
            setattr(self, f"sums{which}", self._sums(which))
        sums, (_, down) = getattr(self, f"sums{which}"), _POWERS[which].of(len(self.data) + 1)
        first, last = self.first[at], self.last[at + n - 1]
        return mix(((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)) ^ mix(self.salt[self.lang[at]] + np.uint64(n)))

    def text(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases' text."""
        first, size = self.first[at], self.last[at + n - 1] - self.first[at]
        offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
        index = np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.data[index].tobytes())).cast(pa.string())


class Filter:
    """A bitmap of hashes: a bit for the hash's remainder."""

    def __init__(self, bits: int, segments: dict[int, bytes]):
        self.bits = bits
        empty = bytes(min(_SEGMENT, bits) // 8)
        self.map = np.frombuffer(b"".join(segments.get(i, empty) for i in range(max(1, bits // _SEGMENT))), dtype=np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & np.uint64(self.bits - 1)
        return (self.map[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def make_filter(keys: DataFrame, most: int) -> Filter:
    """The bitmap of a table of hashes (`key`), put together from segments that are made in parallel."""
    bits = min(most, 1 << max(16, (32 * keys.count()).bit_length()))
    segment = min(_SEGMENT, bits)

    def fill(table: pa.Table) -> pa.Table:
        on = np.zeros(segment, dtype=np.uint8)
        on[table.column("slot").to_numpy() % segment] = 1
        return pa.table({"segment": pa.array([table.column("segment")[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    slots = keys.select(F.col("key").bitwiseAND(bits - 1).alias("slot")).distinct().withColumn("segment", F.floor(F.col("slot") / segment))
    made = slots.groupBy("segment").applyInArrow(fill, "segment long, bits binary")
    return Filter(bits, {r.segment: bytes(r.bits) for r in made.collect()})  # filter_bits / 8 bytes at most


def _scan(docs: DataFrame, look: Callable[[Phrases], Iterator[dict]], schema: str) -> DataFrame:
    """`look` at blocks of texts; it yields columns."""
    names = [x.split()[0] for x in schema.split(", ")]
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for start, end in blocks(texts, _BLOCK):
                for out in look(Phrases(texts[start:end], langs[start:end])):
                    yield pa.RecordBatch.from_arrays([out[name] for name in names], names=names)
        give_back()

    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(run, schema)


def _shard(how: Mining) -> int:
    return TaskContext.get().partitionId() % how.shards


def word_counts(docs: DataFrame, how: Mining) -> tuple[DataFrame, dict[str, int], list[int]]:
    """Counts of words by hash and shard; all words of each language; all words of each shard."""

    def look(found: Phrases) -> Iterator[dict]:
        if not len(found.first):
            return
        keys, counts = np.unique(found.hashes(np.arange(len(found.first)), 1), return_counts=True)
        totals = np.bincount(found.lang, minlength=len(found.langs))
        rows, langs = len(keys) + len(totals), len(totals)
        yield {
            "key": pa.concat_arrays([pa.array(keys.view(np.int64)), pa.nulls(langs, pa.int64())]),
            "shard": pa.array(np.full(rows, _shard(how), np.int32)),
            "lang": pa.concat_arrays([pa.nulls(len(keys), pa.string()), pa.array(found.langs, pa.string())]),
            "n": pa.array(np.concatenate((counts, totals)).astype(np.int64)),
        }

    rows = _scan(docs, look, "key long, shard int, lang string, n long").groupBy("key", "shard", "lang").agg(F.sum("n").alias("n"))
    rows = stage(rows, "words")
    langs, shards = {}, [0] * how.shards
    for r in rows.where("key is null").collect():  # a row for each language and shard
        langs[r.lang] = langs.get(r.lang, 0) + r.n
        shards[r.shard] += r.n
    return rows.where("key is not null").select("key", "shard", "n"), langs, shards


def phrase_counts(docs: DataFrame, n: int, parts, how: Mining) -> DataFrame:
    """Counts by hash and shard of the phrases of n words both of whose parts of n - 1 words are in the filter."""

    def look(found: Phrases) -> Iterator[dict]:
        at = found.starts(n)
        for shift in (0, 1):
            at = at[parts.value.holds(found.hashes(at + shift, n - 1))]
        if len(at):
            keys, counts = np.unique(found.hashes(at, n), return_counts=True)
            yield {"key": pa.array(keys.view(np.int64)), "shard": pa.array(np.full(len(keys), _shard(how), np.int32)), "n": pa.array(counts.astype(np.int64))}

    return _scan(docs, look, "key long, shard int, n long").groupBy("key", "shard").agg(F.sum("n").alias("n"))


def locally_frequent(counts: DataFrame, shards: list[int], how: Mining) -> DataFrame:
    """Hashes that reach, in some shard, the support lowered to the shard's share of the words, rounded up."""
    lowered = [max(1, -(-how.support * n // max(sum(shards), 1))) for n in shards]
    return counts.where(F.col("n") >= F.get(F.array(*map(F.lit, lowered)), F.col("shard"))).select("key").distinct()


def exact_counts(docs: DataFrame, candidates, how: Mining) -> DataFrame:
    """lang, phrase, words and f of all phrases of the candidates that occur `support` times."""

    def look(found: Phrases) -> Iterator[dict]:
        for n in range(1, how.words + 1):
            at = found.starts(n)
            keys = found.hashes(at, n)
            kept = candidates.value.holds(keys)
            at, keys = at[kept], keys[kept]
            if not len(at):
                continue
            others = found.hashes(at, n, 1)  # 128 bits together tell phrases of a block apart
            order = np.lexsort((others, keys))
            keys, others = keys[order], others[order]
            new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (others[1:] != others[:-1]))))
            one = at[order[new]]
            yield {
                "lang": pa.array(found.langs, pa.string()).take(pa.array(found.lang[one])),
                "phrase": found.text(one, n),
                "words": pa.array(np.full(len(one), n, np.int32)),
                "n": pa.array(np.diff(np.append(new, len(keys))).astype(np.int64)),
            }

    rows = _scan(docs, look, "lang string, phrase string, words int, n long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= how.support)


def frequent_phrases(docs: DataFrame, how: Mining = Mining()) -> tuple[DataFrame, dict[str, int]]:
    """All phrases of 1 to `words` words that occur `support` times in a language: lang, phrase, words, f; and each
    language's number of words."""
    spark = docs.sparkSession
    counts, langs, shards = word_counts(docs, how)
    union = stage(locally_frequent(counts, shards, how), "frequent-1")
    for n in range(2, how.words + 1):
        parts = spark.sparkContext.broadcast(make_filter(union, how.filter_bits))
        union = union.union(stage(locally_frequent(phrase_counts(docs, n, parts, how), shards, how), f"frequent-{n}"))
    candidates = spark.sparkContext.broadcast(make_filter(union, how.filter_bits))
    return stage(exact_counts(docs, candidates, how), "phrases"), langs


def _words(phrase: str | Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def _salted_join(cuts: DataFrame, side: str, counts: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """`cuts` with the count of the part in column `side`; rows of hot parts are spread over salts."""
    salts = 32
    part = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    hot = F.broadcast(hot.select("lang", F.col("phrase").alias(side), F.lit(True).alias("hot")))
    many = part.join(hot, ["lang", side], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), salts - 1).otherwise(0))))
    dealt = cuts.join(hot, ["lang", side], "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")).otherwise(0))
    return dealt.drop("hot").join(many.drop("hot"), ["lang", side, "salt"]).drop("salt")


def scored(counts: DataFrame, total: int, how: Mining = Mining()) -> DataFrame:
    """The phrases of two words and more with a, l, r and score of their worst cut, less those that a longer one covers."""
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    hot = stage(counts.where(F.col("f") * 1000 >= total).select("lang", "phrase"), "hot")  # words, 1000 at most; phrases likewise
    phrases = counts.where("words > 1").withColumnRenamed("f", "a")
    at = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", "words", "a", at)
    cuts = cuts.withColumns({"left": _words("phrase", F.lit(1), F.col("k")), "right": _words("phrase", F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = _salted_join(_salted_join(cuts, "left", counts, hot, "l"), "right", counts, hot, "r")
    cuts = cuts.withColumns({"square": F.lit(1000000).cast("decimal(7,0)") * (exact("a") * exact("a")), "product": exact("l") * exact("r")})
    cuts = cuts.withColumn("score", F.expr("square div product"))
    worst = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    covered = inner.select("lang", _words("phrase", F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    rest = worst.join(covered, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * how.redundant))
    return rest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """Each language's best phrases: lang, rank (from 1), phrase, a, l, r, n, score. `docs` has text and lang."""
    spark: SparkSession = docs.sparkSession
    counts, langs = frequent_phrases(docs, how)
    sizes = spark.createDataFrame(list(langs.items()), "lang string, n long")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = scored(counts, sum(langs.values()), how).withColumn("rank", F.row_number().over(W.partitionBy("lang", salt).orderBy(*best))).where(F.col("rank") <= how.top)
    top = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= how.top)
    return top.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB's SQL.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), runs AS (SELECT lang, row_number() OVER () AS run, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, run, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM runs),
grams AS (SELECT lang, w, lead(w) OVER ahead AS w2, lead(w, 2) OVER ahead AS w3 FROM words WINDOW ahead AS (PARTITION BY run ORDER BY i)),
counts AS MATERIALIZED (
  SELECT lang, w AS phrase, 1 AS words, count(*) AS f FROM grams GROUP BY ALL
  UNION ALL SELECT lang, w || ' ' || w2, 2, count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, 3, count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
cuts AS (
  SELECT lang, phrase, words, f AS a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS lft, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rgt
  FROM counts, (VALUES (1), (2)) v(k) WHERE words > k
), firsts AS MATERIALIZED (SELECT c.*, p.f AS l FROM cuts c JOIN counts p ON p.lang = c.lang AND p.phrase = c.lft),
valued AS (
  SELECT c.*, q.f AS r, (1000000::HUGEINT * c.a * c.a // (c.l::HUGEINT * q.f))::BIGINT AS score
  FROM firsts c JOIN counts q ON q.lang = c.lang AND q.phrase = c.rgt
), worst AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') AS phrase FROM counts, (VALUES (1), (2)) v(i) WHERE words = 3) GROUP BY ALL
), ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank, w.phrase, w.a, w.l, w.r, w.score
  FROM worst w LEFT JOIN covered c ON c.lang = w.lang AND c.phrase = w.phrase WHERE c.longer IS NULL OR 100 * c.longer < 50 * w.a
)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE rank <= 2000
"""
