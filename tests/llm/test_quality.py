"""The quality rules against a brute-force version."""

import random
import re
from collections import Counter

import pytest

from llm.quality import Limits, keep_good, measure, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    grams = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    repeat, best = [False] * n, [0] * n
    for i in range(n):
        if i < n - 4 and grams[tuple(words[i : i + 5])] > 1:
            repeat[i : i + 5] = [True] * 5
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best[i] = max(best[i], k)
    long = [(i, b) for i, b in enumerate(best) if b >= 8]
    covered = {k for i, b in long for k in range(i, i + b)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": sum(repeat),
        "base_failed": n < 10 or 100 * sum(repeat) > 20 * n,
        "longest_repeat": max((b for _, b in long), default=0),
        "covered_words": len(covered),
    }


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t", "a", "é è " * 30 + "\x85 q r", "x y z\n" * 40, "# a | b <c>\n\n# a | b <c>\n"]
    out += [" ".join(rng.choice("ab\n") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    once = " ".join(f"w{i}" for i in range(400))
    return [*out, once, once + " " + once, once + " " + " ".join(f"w{i}" for i in range(70))]


def test_measures_equal_brute_force():
    got = measure(texts())
    for i, text in enumerate(texts()):
        assert {k: got[k][i] for k in brute(text)} == brute(text)


def test_long_repeat_is_rejected_by_the_method_alone():
    got = measure([texts()[-1], texts()[-3]], Limits(max_repeat_percent=100, max_covered=100))
    assert got["longest_repeat"].tolist() == [70, 0] and got["kept"].tolist() == [False, True]


@pytest.mark.parametrize("n", [0, 3])
def test_rows_and_extra_columns(spark, n):
    rows = [(1, "a b c d e f g h i j k", "x"), (1, "a b c d e f g h i j k", None), (None, None, "y")][:n]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in quality_rules(df).collect()) == [(0, 0, False), (1, 11, True), (1, 11, True)][:n]
    assert [(r.doc_id, r.kept) for r in keep_good(df).collect()] == [(1, "x"), (1, None)][: 2 * bool(n)]
