"""A corpus pipeline: documents are judged, cleaned of repeated lines, deduplicated, redacted and packed.

Each stage works on all that the one before it kept; all but the last return the columns of `documents`. Empty tables,
nulls, repeated rows and other columns are dealt with as each operator's module says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import jaccard, line_dedup, packing, pii, quality
from llm.columns import set_aside
from llm.tables import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of three lines, of fewer lines of 50 words and of whole short texts go from the texts;
    documents of which no word is left go, too.

    `n_chars` follows the text.
    """
    own, back = set_aside(docs, ["doc_id", "text", "n_chars"], [])
    cut = line_dedup.dedup_lines(own, run=3, words=50)
    kept = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return back(kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays, one row of it; texts without words stay."""
    groups = stage(jaccard.jaccard_components(docs, shingle=5, percent=80).select("doc_id", "component_id"), "groups")
    # rows without an id link nothing; only ids that something happens to meet the texts
    of_id = groups.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("component_id") != F.col("doc_id")).alias("gone"), F.count("*").alias("n"))
    touched = stage(of_id.where("gone or n > 1"), "touched-ids")
    repeated = touched.where("not gone")
    once = docs.join(touched, docs["doc_id"] == touched["doc_id"], "left_anti")
    several = docs.join(repeated, docs["doc_id"] == repeated["doc_id"], "left_semi")
    return once.unionByName(several.dropDuplicates())


def redaction_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in the texts give way to their kinds; `n_chars` follows the text."""
    own, back = set_aside(docs, ["doc_id", "text", "n_chars"], [])
    found = pii.find(own, pii.train(own))
    changed = found.withColumn("changed", F.size("spans") > 0)
    length = F.when(F.col("changed"), F.length("text")).otherwise(F.col("n_chars"))
    return back(pii.redact(changed).withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 4096 tokens."""
    return packing.pack(docs, packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", near_duplicates_stage),
    ("pii", redaction_stage),
    ("best_fit_packing", packing_stage),
]
#: SQL can't express the suffix arrays, the trained trees or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
