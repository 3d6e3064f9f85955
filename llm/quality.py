"""Quality rules: repetition inside a text, measured on its suffix array.

The suffixes of a text's word sequence are sorted by prefix doubling, many texts together. The longest common prefix of
neighbours in that order gives, for each place, the longest run of words from there on that occurs again in the text; the
runs of at least `min_repeat` words are the maximal repeated substrings. Their spans are joined, and a text is rejected
if they cover too much of it or if one of them is too long.

Texts don't need each other, so nothing is shuffled. Null and empty texts have no words and fail the word count. The
result has one row for each input row, repeated rows and null ids included.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.batches import map_texts
from llm.wordhash import gram_hashes, mix, word_hashes

_SPACES = "\t\n\x0b\x0c\r "
_SYMBOLS = "#*$%&|<>"
_WINDOW = 5
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, longest_repeat long, covered_words long, kept boolean"
)


@dataclass(frozen=True)
class Limits:
    """Limits of the rules. Base: words, and per cent of words in repeated 5-word windows. Method: repeats count from
    `min_repeat` words on; they may cover `max_covered` per cent of the words, the longest may have `max_longest` words."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_repeat: int = 8
    max_covered: int = 20
    max_longest: int = 60


def _dense(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of pairs, and for each in that order whether a new pair begins there."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return order, new, np.flatnonzero(new)


def suffix_ranks(words: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words, until all differ; equal ranks are equal prefixes.

    A suffix ends with its text; those of different texts never have equal ranks.
    """
    n = len(words)
    order, new, _ = _dense(owner, words)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = start
    levels, step = [rank], 1
    while True:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            return levels
        after = np.minimum(tied + step, n - 1)
        inside = (tied + step < n) & (owner[after] == owner[tied])
        second = np.where(inside, rank[after], -1)
        order, new, _ = _dense(rank[tied], second)
        base = rank[tied][order]
        group = np.ones(len(base), dtype=bool)
        group[1:] = base[1:] != base[:-1]
        at = np.arange(len(base))
        within = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[tied[order]] = base + within
        levels.append(rank)
        step *= 2


def repeat_lengths(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each place, the most words from there on that occur at another place of the same text too."""
    n = len(words)
    levels = suffix_ranks(words, owner)
    suffixes = np.argsort(levels[-1], kind="stable")
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(max(n - 1, 0), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = (left < n) & (right < n)
        same = inside & (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)])
        # beyond a text's end nothing is equal: ranks of other texts differ
        common[same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    out = np.zeros(n, dtype=np.int64)
    np.maximum.at(out, suffixes[:-1], common)
    np.maximum.at(out, suffixes[1:], common)
    return out


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + lengths, n), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str | None], limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """The measures and verdicts of some texts, by column name."""
    words, at = word_hashes(texts)
    n_words = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), n_words)
    grams = gram_hashes(words, _WINDOW)
    places = np.arange(len(grams))
    places = places[places + _WINDOW <= at[owner[: len(grams)] + 1]]
    keys = grams[places] ^ mix(owner[places].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    ordered = keys[order]
    equal = np.zeros(len(keys), dtype=bool)
    equal[1:] = ordered[1:] == ordered[:-1]
    equal[:-1] |= equal[1:]
    repeated = places[order[equal]]
    total = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[at])
    n_repeat = total(_covered(repeated, np.full(len(repeated), _WINDOW), len(words)))

    longest, covered = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    some = np.unique(owner[repeated])  # only these texts can have repeats of five words or more
    if len(some):
        mask = np.zeros(len(texts), dtype=bool)
        mask[some] = True
        part = np.flatnonzero(mask[owner])
        lengths = repeat_lengths(words[part], owner[part])
        long = lengths >= limits.min_repeat
        np.maximum.at(longest, owner[part][long], lengths[long])
        inside = _covered(np.flatnonzero(long), lengths[long], len(part))
        covered = np.bincount(owner[part][inside], minlength=len(texts)).astype(np.int64)

    def dup_lines(text: str) -> int:
        lines = [x for x in text.split("\n") if x.strip(_SPACES)]
        return len(lines) - len(set(lines))

    whole = [t or "" for t in texts]
    failed = (n_words < limits.min_words) | (100 * n_repeat > limits.max_repeat_percent * n_words)
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, _SPACES)) for t in whole], dtype=np.int64),
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in whole], dtype=np.int64),
        "n_dup_lines": np.array([dup_lines(t) for t in whole], dtype=np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "longest_repeat": longest,
        "covered_words": covered,
        "kept": ~failed & (100 * covered <= limits.max_covered * n_words) & (longest <= limits.max_longest),
    }


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each document: doc_id, the measures, base_failed and kept; see the module's text."""

    def block(texts: list[str | None], rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column("doc_id"), **measure(texts, limits)}

    return map_texts(docs.select("doc_id", "text"), block, SCHEMA)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs`, all columns, whose text the rules keep; other columns pass through untouched."""
    from llm.batches import bound_batches, give_back
    from llm.wordhash import blocks

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text")).to_pylist()
            for start, end in blocks(texts):
                yield batch.slice(start, end - start).filter(pa.array(measure(texts[start:end], limits)["kept"]))
        give_back()

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
