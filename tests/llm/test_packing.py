"""Packing against plain best-fit, and ids against the tokenizer itself."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.packing import Packing, WordEncoder, best_fit, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "<|startoftext|>a <|endoftext|>", "İstanbul ΑΣ ς́ x", "a\xa0b c\x85d e 1234 it's we'LL", "é é x", "\x1c a\x1db",
    "'s 't don't", "ＡＢ①½", "", "Œuvre ßÜ œ, x.y.z!!", "a" * 500, "12 x3y4 --- ...", "日本語 русский", "\x00\x7f",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_word_ids_equal_whole_texts(tokenizer):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("aZé 's'll12.,\n\xa0<|>") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    assert WordEncoder(PATH)([None, *texts]) == [ids(tokenizer, t) for t in [None, *texts]]


def plain_best_fit(lengths, capacity):
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        if at == len(gaps):
            opened += 1
            gap = capacity
        else:
            gap = gaps.pop(at)
        if gap > n:
            bisect.insort(gaps, gap - n)
    return opened


def test_steps_use_as_many_sequences_as_plain_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([1, 10, 50, 4096])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        filled, packed = defaultdict(list), Counter()
        for length, rank, n, first, each, offset in best_fit(Counter(lengths), capacity):
            assert rank == packed[length]
            for j in range(n):
                filled[first + j // each].append((offset + j % each * length, length))
                packed[length] += 1
        assert packed == Counter(lengths)
        for places in filled.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(filled) == plain_best_fit(lengths, capacity)


@pytest.mark.parametrize("rows", [0, 12])
def test_pieces_hold_the_documents(spark, tokenizer, rows):
    rng = random.Random(2)
    data = [(i, " ".join(rng.choice(["the", "loweiü", "x1"]) for _ in range(3 * i)), "piece") for i in range(9)]
    data = [*data, (3, data[3][1], None), (None, None, "a"), (77, " \n", "b")][:rows]
    df = spark.createDataFrame(data, "doc_id long, text string, piece string").repartition(3)
    how = Packing(PATH, capacity=16, with_ids=True)
    out = pack(df, how).collect()
    want = Counter()
    for doc_id, text, _ in data:
        whole = ids(tokenizer, text) + (1).to_bytes(4, "little")
        for at in range(0, len(whole), 64):
            want[doc_id, at // 64, at // 4, whole[at : at + 64]] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in out) == want
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 for r in out)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 16
    assert len(sequences) == plain_best_fit([r.length for r in out], 16)
