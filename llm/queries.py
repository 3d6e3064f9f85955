"""The operators as queries over whole tables: one opN_<name> each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import byte_bpe, collocations, jaccard, language, line_dedup, neighbours, packing, pii, quality, toxicity, unit_dedup, whitening, window_packing

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), shingle=5, percent=80)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), run=3)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~language.held_out()).select("doc_id", "toxic"))
    return toxicity.score(docs, model, threshold=0.3).select("doc_id", language.held_out().alias("held_out"), "score", "predicted")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.summary(pii.find(docs, pii.train(docs)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = language.prototypes(docs.where(~language.held_out()))
    found = language.identify(docs, learned)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.dedup_units(documents(spark, sf_dir).select("doc_id", "text"), kind="sentence", min_words=8, min_chars=20)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), collocations.Mining())


def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack_windows(documents(spark, sf_dir), window_packing.Windows(public_tokenizers.path("word_bpe_49k.json")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), whitening.Whitening(components=8))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collocations": op11_collocations,
    "op12_window_packing": op12_window_packing,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
