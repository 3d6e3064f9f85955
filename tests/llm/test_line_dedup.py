"""Line dedup against a brute-force version."""

import random

import pytest

from llm.line_dedup import dedup_lines
from llm.queries import op2_line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, run=3):
    """Texts by (doc_id, text): a line goes if it stands in a window of `run` worded lines that came before."""
    first, gone = {}, {}
    documents = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    for doc in documents:
        lines = [(i, x.strip(BLANKS)) for i, x in enumerate(doc[1].split("\n")) if x.strip(BLANKS)]
        gone[doc] = set()
        for at in range(len(lines) - run + 1):
            window = tuple(x for _, x in lines[at : at + run])
            at_first = first.setdefault(window, (doc, at))
            if at_first[0] != doc or at >= at_first[1] + run:
                gone[doc] |= {i for i, _ in lines[at : at + run]}
    out = []
    for doc_id, text in rows:
        lost = gone.get((doc_id, text), set())
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)
        runs, n = [], 0 if text is None else len(text.split("\n"))
        for i in range(n):
            if i in lost and i - 1 not in lost:
                runs.append(f"{i}-{min(k for k in range(i, n + 1) if k not in lost)}")
        out.append((doc_id, kept, n, len(lost), ",".join(runs)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        lines = [rng.choice(["a", "b", " a", "c \t", "", " ", "d e", "f"]) for _ in range(rng.randint(0, 14))]
        rows.append((1000 - 7 * i, "\n".join(lines)))
    return [*rows, (5, None), (6, ""), (None, "x\ny\nz\nx\ny\nz"), (2000, "x\ny\nz"), (2000, "x\ny\nz"), (3, "\n".join(["q"] * 9))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    df = spark.createDataFrame([(*r, "x") for r in corpus(seed)], "doc_id long, text string, fingerprint string").repartition(3)
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "fingerprint", "text", "n_lines", "n_removed", "removed_runs"]
    assert sorted((tuple(r) for r in out.drop("fingerprint").collect()), key=str) == brute(corpus(seed))


def test_empty_table_and_only_native_operators(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(df).collect() == []
    plan = op2_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
