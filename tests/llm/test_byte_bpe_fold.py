"""Words folded as arrays of ids, and long ones as text."""

import base64
import random

import public_tokenizers
import tiktoken

from llm.byte_bpe import Vocabulary, encode_words, merged_ids
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_short_and_long_words_have_the_ids_of_the_library(spark):
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, vocabulary = random.Random(3), Vocabulary.read(PATH, public_tokenizers.PATTERN)
    words = ["a", "\u00e9", " the", "aaaaaaa", "=" * 255, "=" * 256, "=" * 257, "\u65e5\u672c" * 50, "e" * 700]
    words += ["".join(rng.choice("abcdehtin") for _ in range(n)) for n in (2, 3, 5, 8, 13, 60, 250, 256, 257, 400)]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    short = F.when(F.octet_length("word") <= 256, merged_ids(F.hex(F.encode("word", "UTF-8")), vocabulary)).alias("short")
    for r in rows.select("word", short, F.get(encode_words(F.array("word"), vocabulary), F.lit(0)).alias("digits")).collect():
        ids = own.encode_ordinary(r.word)
        assert r.short is None or r.short == ids
        assert bytes.fromhex(r.digits) == b"".join(i.to_bytes(4, "little") for i in ids)
