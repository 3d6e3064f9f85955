"""Whole lines and paragraphs go with the short sentences in them."""

import random

from llm.unit_dedup import dedup_units, nested_units


def brute(rows, min_words, min_chars):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        gone = set()
        for start, end, digest in sorted(nested_units(text, "sentence", min_words, min_chars), key=lambda u: (u[0], -u[1])):
            if digest in seen:
                gone |= set(range(start, end))
            seen.add(digest)
        out[doc_id] = "".join(c for i, c in enumerate(text) if i not in gone)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    pieces = ["a b c.", "A, b c!", "d e f\n", "\n\n", " \n", "x y z w? ", "g", " h i j. ", "\u6587\u5b57\u3002", "..."]
    rows = [(500 - 3 * i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))) for i in range(80)]
    got = dedup_units(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "sentence", 3, 6).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows, 3, 6)


def test_short_sentences_go_with_their_line(spark):
    line = "Stop here. Go on. Look left. Turn around now. " + "One of the sentences in it is a long one indeed."
    thai, chinese = "\u0e01\u0e02" * 15, "\u4eca\u5929\u5929\u6c14\u5f88\u597d\uff0c\u6211\u4eec\u53bb\u516c\u56ed\u91cc\u6563\u6b65\u804a\u5929\u5427\u3002"
    few = "Subscribe to our newsletter today"
    rows = [(2 * i + k, f"own {i} {k}\n{x}\nother {i} {k}") for i, x in enumerate([line, thai, few]) for k in (0, 1)]
    rows += [(10, f"\u524d{chinese}\u540e"), (11, f"\u7532\u4e59\u3002{chinese}\u540e\u6765"), (12, f"\u4e19\u3002{chinese}\u540e\u9762")]
    rows += [(20, "... again and again, the same words are here, twice"), (21, "unlike all the others in this table of rows")]
    out = {r.doc_id: r.text for r in dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=20).collect()}
    assert [out[i] for i in (1, 3, 5)] == ["own 0 1\n\nother 0 1", "own 1 1\n\nother 1 1", "own 2 1\n\nother 2 1"]
    assert out[12] == "\u4e19\u3002\u540e\u9762"
    assert all(out[i] == t for i, t in rows if i in (0, 2, 4, 10, 11, 20, 21))
