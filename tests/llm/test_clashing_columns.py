"""Other columns keep their names and values, whatever an operator calls its own."""

import pytest

import corpus_pipeline
from llm import line_dedup, pii, unit_dedup

NAMES = ["_id", "_of", "_hash", "removed", "text_hash", "spans", "base", "_changed", "changed", "n", "gone", "component_id", "line", "start", "end", "digest", "a.b", "c`d"]
LINE = "some words that stand in a line of their own here and there"
TEXTS = [f"{LINE}\n{LINE} two\n{LINE} three\nmail a@b.com", f"{LINE}\n{LINE} two\n{LINE} three\nother", "clean and short", None]


def table(spark, *more):
    names = [*NAMES, *more]
    schema = "doc_id long, text string, n_chars long, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return spark.createDataFrame([(i, t, len(t or ""), *[f"{n}{i}" for n in names]) for i, t in enumerate(TEXTS)], schema), names


def check(found, names, gone=()):
    assert len(found.columns) == len(set(found.columns))
    rows = found.collect()
    for r in rows:
        got = r.asDict()
        assert {n: got[n] for n in names if n not in gone} == {n: f"{n}{r.doc_id}" for n in names if n not in gone}
    return rows


@pytest.mark.parametrize(("operator", "made"), [(line_dedup.dedup_lines, "n_removed removed_runs"), (unit_dedup.dedup_units, "n_removed removed_spans")])
def test_deduplication(spark, operator, made):
    docs, names = table(spark, *made.split())
    rows = check(operator(docs), names, made.split())
    assert len(rows) == 4 and {r.doc_id: r.n_removed > 0 for r in rows} == {0: False, 1: True, 2: False, 3: False}


def test_redaction(spark):
    docs, names = table(spark)
    rows = check(pii.redact(pii.find(docs, pii.train(docs))), names)
    assert len(rows) == 4 and "[EMAIL]" in next(r.text for r in rows if r.doc_id == 0)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[1:4])
def test_stages(spark, name, stage):
    docs, names = table(spark, "n_removed", "n_lines", "base of docs")
    found = stage(spark, docs, "")
    assert found.columns == docs.columns
    check(found, names)


def test_one_row_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, 0), (2, long, 0), (2, long, 0), (3, "other words here", 0), (3, "other words here", 0), (None, long, 0), (4, None, 0), (5, "alone", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = corpus_pipeline.near_duplicates_stage(spark, docs, "")
    assert sorted((r.doc_id or 0) for r in found.collect()) == [0, 1, 3, 4, 5]
