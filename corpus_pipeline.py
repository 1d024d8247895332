"""A training corpus from raw documents: toxicity, line dedup, near-duplicates, decontamination, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to
the shared folder and read again as the next stage's docs. All stages but the last return the
columns of docs; the last adds copy, the number of each copy of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import contamination, linededup, mixing, neardup, toxicity
from leafmill.llm.common import shared_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go. It learns from those that the labels cover."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines equal but for one edit the earliest stays; documents left without any line go."""
    return linededup.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.without_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut from the texts; documents that are nothing else go."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that every source has the same share of characters."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
]

#: The network, the signatures and the rounding are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the stages make of sf_dir's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
