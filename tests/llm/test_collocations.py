"""Collocations against a plain count, over odd rows, and by shard."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.collocations import Filter, Mining, Phrases, collocations, frequent_phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, key long"


def plain_counts(rows, longest):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts, sizes


def plain(rows, how):
    counts, sizes = plain_counts(rows, how.words)
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= how.support}
        inside = Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        best = []
        for p, a in found.items():
            if 100 * inside[p] >= how.redundant * a:
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[: how.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, lang, "x", i, None) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["New", "york", "CITY", "of", "the", "Straße", "çb", "ÉCOLE", "日本", "\x85", "a\xa0b", "𝒳", "x"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", "; ", "\x0b"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    out = [(t, rng.choice(["en", "en", "de", "und", None])) for t in texts]
    return out + [("new york city hall " * 40, "en")] * 7 + [("", "en"), (None, "en"), (None, None), (" .\t, ", "fr"), ("one", "one")]


@pytest.mark.parametrize("how", [Mining(), Mining(support=3, words=4, shards=2, top=50, redundant=80), Mining(support=40, words=2, shards=9, filter_bits=1 << 16)])
def test_equals_a_plain_count(spark, rows, how):
    assert sorted(tuple(r) for r in collocations(table(spark, rows), how).collect()) == plain(rows, how)


def test_a_full_bitmap_changes_nothing(spark, rows):
    how = Mining(filter_bits=64)
    assert sorted(tuple(r) for r in collocations(table(spark, rows), how).collect()) == plain(rows, how)


@pytest.mark.parametrize("parts", [1, 13])
def test_every_frequent_phrase_is_in_the_union_whatever_the_shards(spark, rows, parts):
    found, sizes = frequent_phrases(table(spark, rows, parts), Mining())
    counts, totals = plain_counts(rows, 3)
    want = {(lang, " ".join(p), a) for lang, f in counts.items() for p, a in f.items() if a >= 10}
    assert {(r.lang, r.phrase, r.f) for r in found.collect()} == want
    assert {k: v for k, v in sizes.items() if v} == {k: v for k, v in totals.items() if v}


def test_ties_go_by_bytes_and_to_the_first_cut(spark):
    rows = [(f"{w} {w}x. {w}x {w}", "en") for w in ("é", "z", "Z~", "a", "𝒳", "ﬀ") for _ in range(10)]
    got = [r.phrase for r in collocations(table(spark, rows)).orderBy("rank").collect()]
    assert got == [p for _, _, p, *_ in sorted(plain(rows, Mining()), key=lambda r: r[1])]
    three = collocations(table(spark, [("a b c", "en")] * 12)).collect()
    assert [tuple(r) for r in three] == [("en", 1, "a b c", 12, 12, 12, 36, 1000000)]


def test_tables_without_words(spark):
    for rows in ([], [(None, None), ("", "en"), (" . \n", "en")]):
        assert collocations(table(spark, rows, 1)).collect() == []


def test_a_long_text_is_counted_whole(spark):
    rows = [("alpha beta gamma. " * 200_000, "en"), ("alpha beta", None)]
    (best,) = collocations(table(spark, rows, 2)).collect()
    assert (best.phrase, best.a, best.n) == ("alpha beta gamma", 200_000, 600_000)


def test_hashes_tell_phrases_apart():
    found = Phrases(["a b. b a", "ab a  b\tc"], ["x", "x"])
    at = found.starts(2)
    assert found.text(at, 2).to_pylist() == ["a b", "b a", "ab a", "a b", "b c"]
    keys = found.hashes(at, 2)
    assert keys[0] == keys[3] and len(set(keys.tolist())) == 4
    assert found.hashes(found.starts(1), 1)[0] != Phrases(["a"], ["y"]).hashes(np.array([0]), 1)[0]


def test_the_bitmap_holds_what_was_put_in():
    part = bytes([0b10000001]) + bytes(7)
    assert Filter(64, {0: part}).holds(np.array([0, 1, 7, 64, 71], np.uint64)).tolist() == [True, False, True, True, True]
