"""Corpus pipeline: documents through a chain of the text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm import op1_minhash_dedup, op3_toxicity, op6_language_id, op7_best_fit_packing, op9_decontamination
from starforge.llm.common import read_table, staged
from starforge.llm.queries import MAX_TOKENS, tokenizer_file

# A text whose language is this uncertain is rejected (a share of the mean window probability).
MIN_LANGUAGE_SCORE = 0.4

# Classifiers, token packing and edit distances in text have no SQL form; the pipeline is tested against
# a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learned from the labels of the documents outside the held-out fold."""
    return op3_toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognized language."""
    return op6_language_id.with_known_language(docs, MIN_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return op1_minhash_dedup.one_of_each(docs, op1_minhash_dedup.near_duplicate_classes(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    for clean in op9_decontamination.clean_conditions(read_table(spark, sf_dir, "benchmark"), F.col("text")):
        docs = docs.where(clean)
    return docs


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as packed token sequences."""
    return op7_best_fit_packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), MAX_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
