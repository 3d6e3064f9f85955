"""Long values are proposed and redacted whole."""

import random

from pyspark.sql import functions as F

from llm import pii


def proposed(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = rows.select("doc_id", F.transform(pii.candidates(F.col("text")), lambda c: F.struct(c["generator"].alias("g"), c["start"].alias("a"), c["end"].alias("b"))).alias("c"))
    return {r.doc_id: {(list(pii.GENERATORS)[c.g], texts[r.doc_id][c.a : c.b]) for c in r.c} for r in found.collect()}


def test_long_values_are_proposed_whole(spark):
    jwt, digest, mail = "eyJ0." + "aZ9-" * 100 + "._x", "0a1b2c3d" * 16, "\u00e9" * 80 + "@" + "b" * 220 + ".org"
    got = proposed(spark, [f"x token={jwt} y", f"sha {digest}.", f"to {mail} now", "-" * 30000 + " " + "x" * 30000])
    assert ("assigned", f"token={jwt}") in got[0] and got[1] == {("token", digest)}
    assert got[2] == {("address", mail)} and got[3] == set()


def test_a_long_secret_is_redacted_whole(spark):
    rng = random.Random(2)
    key = lambda n: "".join(rng.choice("0123456789") + rng.choice("abcdef") for _ in range(n // 2))
    rows = [(i, f"some words here token={key(36 if i < 290 else 300)} and more") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in pii.redact(pii.find(df, pii.train(df))).collect()} == {"some words here [SECRET] and more"}
