"""Unit dedup against a brute-force version, and on a passage that documents share."""

import random

import pytest

from llm.unit_dedup import dedup_units, units


def brute(rows, kind, min_words):
    seen, spans = set(), {}
    for doc in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        spans[doc] = []
        for start, end, digest in units(doc[1], kind, min_words):
            if digest in seen:
                spans[doc].append((start, end))
            seen.add(digest)
    out = []
    for doc_id, text in rows:
        gone, kept, at = spans.get((doc_id, text), []), "", 0
        for a, b in gone:
            kept, at = kept + text[at:a], b
        kept = None if text is None else kept + text[at:]
        out.append((doc_id, kept, len(gone), sum(b - a for a, b in gone), ",".join(f"{a}-{b}" for a, b in gone)))
    return sorted(out, key=str)


def test_units_cover_the_text():
    text = "A b c. D e f! v1.2 is out\n\nNext line? Yes \U0001f600 x.\n \n end"
    cut = {k: [text[a:b] for a, b, _ in units(text, k, 1)] for k in ("sentence", "line", "paragraph")}
    assert cut["sentence"] == ["A b c.", "D e f!", "v1.2 is out", "Next line?", "Yes \U0001f600 x.", "end"]
    assert cut["line"] == ["A b c. D e f! v1.2 is out", "Next line? Yes \U0001f600 x.", "end"]
    assert cut["paragraph"] == ["A b c. D e f! v1.2 is out", "Next line? Yes \U0001f600 x.", "end"]
    assert units("One, TWO", "line", 2)[0][2] == units(" one two!", "line", 2)[0][2] and units("a b", "line", 3) == []


@pytest.mark.parametrize("kind", ["sentence", "line", "paragraph"])
def test_equals_brute_force(spark, kind):
    rng = random.Random(5)
    pieces = ["a b c.", "A, b c!", "d e f\n", "\n\n", " \n", "x\U0001f600y z w? ", "g", " h i j. "]
    rows = [(500 - 3 * i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(None, "a b c. zz yy xx."), (7, None), (8, ""), (900, "a b c."), (900, "a b c.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string").repartition(3)
    got = dedup_units(df, kind, 3)
    assert got.columns == ["doc_id", "digest", "text", "n_removed", "removed_chars", "removed_spans"]
    assert sorted((tuple(r) for r in got.drop("digest").collect()), key=str) == brute(rows, kind, 3)
    assert dedup_units(df.limit(0), kind, 3).collect() == []


def test_a_shared_passage_goes_from_all_but_the_first(spark):
    rng = random.Random(9)
    sentence = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12)) + "."
    passage = " ".join(sentence() for _ in range(5))
    rows = [(i, f"{sentence()} {sentence()[:-1]} {passage} {sentence()}") for i in range(20)]
    rows += [(i, " ".join(sentence() for _ in range(8))) for i in range(20, 40)]
    out = {r.doc_id: r for r in dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].n_removed for i in range(40)] == [0] + [4] * 19 + [0] * 20
