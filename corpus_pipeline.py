"""The corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame, which ``run`` writes as Parquet and reads again for the
next.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import packing, quality_gam, substring_dedup, toxicity_knn, weighted_minhash
from tickloom.llm.common import free_name, materialize, text_crc_mod
from tickloom.llm.registry import tokenizer_file
from tickloom.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    model = toxicity_knn.learn(docs, table(spark, sf_dir, "labels"), text_crc_mod(F.col("doc_id"), 5) != 0)
    score, evidence = free_name(docs, "toxicity"), free_name(docs, "toxicity_evidence")
    scored = toxicity_knn.with_toxicity(docs, model, score_col=score, evidence_col=evidence)
    return scored.filter(F.col(score) < 0.5).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is at least one half."""
    model = quality_gam.learn(docs, table(spark, sf_dir, "labels"), text_crc_mod(F.col("doc_id"), 3) != 1)
    score = free_name(docs, "quality")
    return quality_gam.with_quality(docs, model, score_col=score).filter(F.col(score) >= 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return weighted_minhash.one_of_each_group(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that occurred before."""
    return substring_dedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(packing.token_pieces(docs, tokenizer_file("byte_bpe_50k.json"), "<|endoftext|>"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: SQL cannot express the two classifiers and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
