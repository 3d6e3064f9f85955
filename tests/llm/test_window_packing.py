"""Window packing against a plain search over all cuts, and against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.window_packing import Packer, Windows, ending, pack_windows, places_of

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = Windows(PATH, capacity=16, sentence=2, inside=5, stride=4)


def padding(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


def plain_cost(lengths, places, how):
    """The least padding and penalties of any way to cut, and the fewest sequences of such."""
    best = {0: (0, 0)}
    for place in sorted(places):
        best[place] = min((best[i][0] + padding(place - i, how.capacity) + places[place], best[i][1] + 1) for i in best if place - how.capacity <= i < place)
    return best[sum(lengths)]


def line(docs, stops, how):
    """All places of a task's line and what they cost."""
    at, places = 0, {}
    for ids in docs:
        for place, penalty in zip(*places_of(ids, stops, how)):
            places[at + int(place)] = int(penalty)
        at += len(ids)
    for place in range(max(at - how.capacity, 1), at):
        places.setdefault(place, how.inside)
    return places


@pytest.mark.parametrize("seed", range(30))
def test_no_way_to_cut_is_cheaper(seed):
    rng = random.Random(seed)
    stops = np.zeros(10, dtype=bool)
    stops[3] = True
    how = [SMALL, Windows(PATH, capacity=8, sentence=1, inside=1, stride=8, with_ids=False), Windows(PATH, capacity=64, sentence=9, inside=30, stride=17)][seed % 3]
    docs = [np.array([rng.choice([1, 3, 4, 5, 5, 6]) for _ in range(rng.choice([0, 1, 3, 7, 16, 40, 200]))] + [2], dtype="<u4") for _ in range(rng.randint(1, 40))]
    packer, rows = Packer(how, stops, 100), []
    for i, ids in enumerate(docs):
        packer.add(i, ids.tobytes())
        if rng.random() < 0.4:
            rows += packer.block()
    rows += packer.block(last=True)
    places = line(docs, stops, how)
    cost, sequences, used, at = 0, sorted({r[5] for r in rows}), 0, 0
    for s in sequences:
        n = sum(r[2] for r in rows if r[5] == s)
        at += n
        assert n <= how.capacity
        cost += padding(n, how.capacity) + places[at]
        used += 1
    assert at == sum(map(len, docs)) and not packer.docs
    assert (cost, used) == plain_cost([len(d) for d in docs], places, how)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, how):
    """Every id in one piece, pieces gapless and in order in their sequences; returns padding and tokens."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, how.end]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r.length])
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(data), len(ids)) and r.length > 0
            at += r.length
        assert at == len(ids)
    total = pad = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= how.capacity
        total, pad = total + at, pad + padding(at, how.capacity)
    return pad, total


ODD = ["", None, "One. Two! Three?", "x", "no stops " * 400, "日本語。テスト！", "...", "a.b.c", "3.14 <|endoftext|> é"]


def table(spark, texts, parts):
    rows = [(i, t, 1, "s", 2) for i, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, lang string, sequence_id int").repartition(parts)


@pytest.mark.parametrize("parts", [1, 7])
def test_whole_texts_in_gapless_sequences(spark, tokenizer, parts):
    rng = random.Random(parts)
    texts = dict(enumerate(ODD + [" ".join(rng.choice(["word", "other.", "Thing", "it's", "2024!"]) for _ in range(rng.randint(0, 300))) for _ in range(150)]))
    how = Windows(PATH, capacity=256, stride=64)
    pad, total = check(pack_windows(table(spark, texts, parts), how).collect(), texts, tokenizer, how)
    assert pad < 0.05 * total


def test_the_corpus_has_little_padding(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    how = Windows(PATH)
    pad, total = check(pack_windows(docs, how).collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer, how)
    assert pad < 0.005 * total


def test_a_long_text_spans_many_sequences(spark, tokenizer):
    texts = {1: "A sentence of words here. " * 60_000, 2: "word " * 50_000, 3: "z" * 30_000}
    pad, total = check(pack_windows(table(spark, texts, 1), Windows(PATH)).collect(), texts, tokenizer, Windows(PATH))
    assert total > 400_000 and pad < 0.002 * total


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(5, "a b", 1, "s", 2)] * 3 + [(None, "c", 1, "s", 2)]
    schema = "doc_id long, text string, start int, lang string, sequence_id int"
    found = pack_windows(spark.createDataFrame(rows, schema), Windows(PATH, with_ids=True)).collect()
    assert sorted((r.doc_id or 0, sum(x.length for x in found if x.doc_id == r.doc_id)) for r in found if r.start == 0) == [(0, 2), (5, 9), (5, 9), (5, 9)]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    assert pack_windows(spark.createDataFrame([], schema), Windows(PATH)).collect() == []


def test_parameters_that_allow_no_cut_are_refused(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    for how in (Windows(PATH, capacity=100), Windows(PATH, stride=0), Windows(PATH, capacity=16, stride=17)):
        with pytest.raises(ValueError, match="power of two"):
            pack_windows(docs, how)


def test_ends_of_sentences(tokenizer):
    stops = ending(tokenizer.get_vocab(), "</w>")
    words = lambda text: stops[tokenizer.encode(text, add_special_tokens=False).ids].tolist()
    assert words("yes . no , ok ?!") == [False, True, False, False, False, True]
