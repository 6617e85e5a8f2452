"""A corpus pipeline of the operators in gridpanel.llm; each stage's output is written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpanel.llm import line_dedup, minhash, mixing, packing, quality
from gridpanel.llm.common import read, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_documents(docs, read(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; documents stay, with what is left of their text."""
    return line_dedup.drop_lines(docs, min_docs=10, min_points=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes once for each time the mix takes words of it."""
    return mixing.materialize(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("minhash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The trees of the first stage and the greedy packing of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs
