"""Words folded in Arrow batches."""

import base64
import random
import struct

import public_tokenizers
import tiktoken

from llm.byte_bpe import Vocabulary, Words, decode, encode, fold
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ranks_and_library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_of_any_length_have_the_ids_of_the_library():
    (ranks, own), rng = ranks_and_library(), random.Random(5)
    words = ["a", "é", "aaaaaaa", "=" * 257, "日本" * 500, "a" * 20_000, "".join(rng.choice("abcdehtin") for _ in range(50_000))]
    words += ["".join(rng.choice("abcdehtiné") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for word in words:
        assert fold(word.encode(), ranks) == own.encode_ordinary(word)


def test_a_bounded_number_of_words_is_remembered():
    (ranks, own), rng = ranks_and_library(), random.Random(6)
    words = Words(ranks, most=30)
    for _ in range(5000):
        word = " " + "".join(rng.choice("abe") for _ in range(min(1 + int(rng.expovariate(0.3)), 90)))
        ids = own.encode_ordinary(word)
        assert words[word] == struct.pack(f"<{len(ids)}I", *ids)
        assert len(words) + len(words.older) <= 30


def test_plans_hold_no_vocabulary_and_texts_are_read_once(spark):
    """The literals of the vocabulary and of 200,000 words filled the driver's memory."""
    before = spark.conf.get("spark.sql.maxPlanStringLength")
    rows = spark.createDataFrame([(None, "it's ééé", [1]), (1, None, None), (1, "", None)], "doc_id long, text string, other array<int>")
    vocabulary = Vocabulary.read(PATH, public_tokenizers.PATTERN)
    coded = encode(rows, vocabulary).select("doc_id", "other", "ids", F.length("ids").alias("n"), decode(F.col("ids"), vocabulary).alias("back"))
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000 and spark.conf.get("spark.sql.maxPlanStringLength") == before
    assert plan.count("ArrowEvalPython") == 2 and "Exchange" not in plan
    got = sorted(((r.doc_id, r.other, r.n, bytes(r.back)) for r in coded.collect()), key=str)
    n = 4 * len(ranks_and_library()[1].encode_ordinary("it's ééé"))
    assert got == sorted([(None, [1], n, "it's ééé".encode()), (1, None, 0, b""), (1, None, 0, b"")], key=str)
