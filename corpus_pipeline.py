"""From raw documents to a training mix: each stage calls one operator and works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netsift.llm import chunks, decontam, jaccard, mixing, toxicity
from netsift.llm.common import forget, keep, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier elsewhere are cut; documents of which nothing is left go."""
    return chunks.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document stands in the mix, and its words there."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", one_of_near_copies),
    ("substrings", without_repeats),
    ("benchmark", without_benchmark),
    ("mixing", mixed),
]

#: Learned classifiers, hashes and Newton steps have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents table: doc_id and the rest of mix_sources() for each row that the stages before keep.

    Nulls in any column, empty and very long texts, repeated rows and extra columns pass through: such rows are clean unless
    their text says otherwise. A null doc_id is never a copy of another row nor contaminated, so it stays. Repeated rows are
    judged alike. Empty tables give no rows. Each stage's table is deleted once the next one is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
