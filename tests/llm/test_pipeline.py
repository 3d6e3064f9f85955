"""The pipeline against plain versions of its stages."""

import random
import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard import brute as components
from test_line_dedup import brute as dedup
from test_pii import RULES, luhn
from test_quality import brute as judge

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(n))
    lines = [words(9) for _ in range(4)]
    texts = [words(40) for _ in range(10)]
    texts += [" ".join(texts[i].split()[:-1] + ["z"]) for i in range(3)] + [texts[4]]
    texts += ["\n".join([words(8), *lines, words(8)]) for _ in range(4)] + ["\n".join(lines), "too short", "again and " * 30, "", None]
    texts += [f"{words(12)} me{i}@x.org {words(12)} +1 (523) 555-1055" for i in range(3)]
    rows = [(100 + 3 * i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, words(20), None, None, None)]


def expected(rows):
    rows = [r for r in rows if (m := judge(r[1])) and not m["base_failed"] and 100 * m["covered_words"] <= 20 * m["n_words"]]
    cut = {(a, t): x for (a, t), x in zip(sorted((r[:2] for r in rows), key=str), [None] * len(rows))}
    gone = {}
    for row in rows:
        for out in dedup([r[:2] for r in rows]):
            if out[0] == row[0]:
                gone.setdefault(row[:2], out[1])
    texts = sorted({(a, gone[a, t]) for a, t in cut if gone[a, t].strip()}, key=str)
    known = [t for t in texts if t[0] is not None]
    keep = {i for i, _, c in components(known) if i == c}
    return [t for t in texts if t[0] is None or t[0] in keep]


def redacted(text):
    spans = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind in ("email",) or (kind == "phone" and 10 <= len(digits) <= 15) or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)):
                spans.append((m.start(), m.end(), kind))
    for start, end, kind in sorted(spans, reverse=True):
        text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
    return text


def test_stages_equal_plain_versions(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.count())
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.doc_id is not None)
    want = [(i, redacted(t)) for i, t in expected(rows)]
    fourth = spark.read.parquet(f"{tmp_path}/3").collect()
    assert sorted([(r.doc_id, r.text) for r in fourth], key=str) == sorted(want, key=str)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(i, [*tokenizer.encode(t, add_special_tokens=False).ids, 1]) for i, t in want]
    crc = lambda x: zlib.crc32(b"".join(k.to_bytes(4, "little") for k in x))
    assert sorted([(r.doc_id, r.length, r.ids_crc32) for r in docs.collect()], key=str) == sorted([(i, len(x), crc(x)) for i, x in ids], key=str)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.ids_crc32) for r in whole) == sorted((i or 0, crc(x)) for i, x in ids)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
