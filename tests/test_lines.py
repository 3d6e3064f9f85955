"""Line numbers of files read in many splits, and how the text is read."""

import random

import pytest
from pyspark.errors import AnalysisException

from logwarden.plans.workarea import WorkArea
from logwarden.sources.lines import read_log_lines, splits_of


def write(folder, name, lines, ends=("\n",), last=True):
    rng = random.Random(name)
    data = b"".join(line.encode() + rng.choice(ends).encode() for line in lines)
    (folder / name).write_bytes(data if last else data.rstrip(b"\r\n"))


def test_numbers_over_many_splits(spark, tmp_path):
    rng = random.Random(1)
    texts = {
        "a.log": [f"line {i} " + "x" * rng.randint(0, 60) if rng.random() < 0.8 else rng.choice(["", "  "]) for i in range(1500)],
        "b.log": [f"{i}" for i in range(900)],
        "c d%.log": ["ü" * 700, "", "z"] * 20,
        "empty.log": [],
    }
    write(tmp_path, "a.log", texts["a.log"], ("\n", "\r\n"))
    write(tmp_path, "b.log", texts["b.log"], ("\r\n",), last=False)
    write(tmp_path, "c d%.log", texts["c d%.log"], ("\n", "\r\n", "\r"))
    write(tmp_path, "empty.log", [])
    work = WorkArea(spark)
    with splits_of(spark, 300):
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
        found = read_log_lines(spark, str(tmp_path), work).collect()
    by_file = {}
    for r in found:
        by_file.setdefault(r.path.rsplit("/", 1)[-1], []).append((r.line_number, r.value))
    want = {name.replace(" ", "%20").replace("%.", "%25."): list(enumerate(lines, 1)) for name, lines in texts.items() if lines}
    assert {k: sorted(v) for k, v in by_file.items()} == want
    work.clear()


def test_the_text_is_read_once(spark, tmp_path):
    write(tmp_path, "a.log", ["x", "y"])
    lines = read_log_lines(spark, str(tmp_path), WorkArea(spark))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("FileScan parquet") == 2
    # the files may go: what is read is what was written
    (tmp_path / "a.log").write_text("other")
    assert sorted((r.line_number, r.value) for r in lines.collect()) == [(1, "x"), (2, "y")]


def test_a_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_log_lines(spark, str(tmp_path / "none.log"), WorkArea(spark))
