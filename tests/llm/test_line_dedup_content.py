"""Line dedup where content completes a window, against a brute-force version."""

import random

from llm.line_dedup import dedup_lines
from test_line_dedup import BLANKS


def brute(rows, run, words):
    first, gone = {}, {}
    for doc in sorted(set(rows)):
        lines = [(i, x.strip(BLANKS)) for i, x in enumerate(doc[1].split("\n")) if x.strip(BLANKS)]
        gone[doc] = set()
        for size in range(1, run + 1):
            for at in range(len(lines) - size + 1):
                window = tuple(x for _, x in lines[at : at + size])
                if size < run and sum(len(x.split()) for x in window) < words and len(lines) != size:
                    continue
                at_first = first.setdefault(window, (doc, at))
                if at_first[0] != doc or at >= at_first[1] + size:
                    gone[doc] |= {i for i, _ in lines[at : at + size]}
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]) for d in gone}


def test_equals_brute_force(spark):
    rng = random.Random(3)
    pieces = ["a", "b", "c d e", " c d e f g", "h i j k l m", "", "p q\tr s "]
    rows = [(900 - 7 * i, "\n".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), run=3, words=5).collect()
    assert {r.doc_id: r.text for r in got} == {d[0]: t for d, t in brute(rows, 3, 5).items()}


def test_a_long_line_between_different_neighbours_and_a_short_copy_go(spark):
    long, wide = " ".join(f"w{i}" for i in range(60)), "\u6587\u5b57" * 30
    rows = [(i, f"own{i}\n{text}\nother{i}") for i, text in enumerate([long, long, wide, wide])]
    rows += [(10, "only these words"), (11, "only these words"), (12, "only these words\nand one more\nand another")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in dedup_lines(df, run=3, words=50).collect()}
    assert [out[i] for i in (0, 2, 10, 12)] == [rows[0][1], rows[2][1], rows[4][1], rows[6][1]]
    assert [out[i] for i in (1, 3, 11)] == ["own1\nother1", "own3\nother3", ""]
