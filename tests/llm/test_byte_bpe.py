"""Byte-level BPE against the tiktoken library."""

import base64
import random

import public_tokenizers
import tiktoken

from llm.byte_bpe import Vocabulary, decode, encode
from llm.queries import op10_byte_bpe
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    out = [None, "", "  ", "it's we'LL", "a\xa0b  c\x85d e ​ x", "\x1c a\x1d", "日本語 русский עברית", "👩‍👩‍👧 é", "=" * 30]
    out += ["x1y22z333 ½ ²", "\n\n\n  a \t b\r\n", "'s 't 'RE", "a" * 150 + "b" * 80, "<|endoftext|>", "a,b,,c,"]
    out += ["".join(rng.choice("ab cé'sd\n 12=-_.Zt　") for _ in range(rng.randint(0, 120))) for _ in range(80)]
    return out + ["".join(rng.choice("abcdeht") for _ in range(rng.randint(1, 50))) for _ in range(120)]


def test_each_token_is_made_of_two_by_merges_of_lower_rank():
    """What lets a round merge a pair wherever it stands."""
    ranks = {k: v for k, v in Vocabulary.read(PATH, "").ranks.items()}
    for piece in random.Random(2).sample(sorted(ranks), 6000):
        parts = [piece[i : i + 2] for i in range(0, len(piece), 2)]
        while len(parts) > 2:
            best = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            assert best[0] < ranks[piece]
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]


def test_ids_equal_the_library_and_come_back(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a b", "y"), (3, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(2)
    vocabulary, own = Vocabulary.read(PATH, public_tokenizers.PATTERN), library()
    got = encode(df, vocabulary, most=20).withColumn("back", decode(F.col("ids"), vocabulary)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in own.encode_ordinary(r.text or ""))
        assert bytes(r.back) == (r.text or "").encode()


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op10_byte_bpe(spark, str(tmp_path)).collect() == []
