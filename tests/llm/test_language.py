"""Language profiles: the vectors by definition, and accuracy on held-out documents."""

import zlib

import numpy as np

from llm.language import Profile, Vectors, grams, held_out, identify, prototypes
from llm.queries import op8_language_id


def test_grams_are_those_of_the_letters():
    codes, counts = grams("Ab, 1c\nAB", 2)
    got = {tuple(chr(c >> s & 0x1FFFFF) for s in (21, 0)): k for c, k in zip(codes.tolist(), counts.tolist())}
    assert got == {("\0", "a"): 2, ("a", "b"): 2, ("b", "\0"): 2, ("\0", "c"): 1, ("c", "\0"): 1}
    assert [len(grams(t, 3)[0]) for t in (None, "", "12 .\n", "é")] == [0, 0, 0, 1]


def test_binding_permutes_by_place_and_bundling_adds():
    profile = Profile(n=2, size=64)
    vectors = Vectors(profile)
    codes, counts = grams("abab", 2)
    want = sum(k * vectors._letter(c & 0x1FFFFF) * np.roll(vectors._letter(c >> 21), 1) for c, k in zip(codes.tolist(), counts.tolist()))
    assert np.array_equal(vectors.bundle(codes, counts), want)
    vectors.most = 4  # forgotten vectors come back the same
    assert np.array_equal(vectors.bundle(codes, counts), want)


def test_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en", 9.0), (2, "der hund und die katze", "de", None), (3, None, "en", 0.0)]
    rows += [(4, " 12 ", None, 0.0), (None, "und die", "xx", 0.0), (1, "the cat and the dog", None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    learned = prototypes(df.where("doc_id < 4"))
    assert list(learned) == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in identify(df, learned).collect()]
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (None, "de"), (1, "en")]
    assert all(0 <= r.score <= 1 for r in identify(df, learned).collect())
    assert {r.lang_pred for r in identify(df, {}).collect()} == {"und"}
    assert identify(df.limit(0), learned).collect() == [] and prototypes(df.limit(0)) == {}


def test_held_out_rule(spark):
    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op8_language_id(spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
