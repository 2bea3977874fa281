"""The training-data pipeline: quality rules, line dedup, near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import line_dedup, ngram_join, packing, pii_crf, quality_rules
from ledgerlake.llm.common import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or their host's verdict rejects go."""
    return quality_rules.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go, and documents that were nothing else."""
    return line_dedup.drop_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii_crf.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, its ids included."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", repeated_lines),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packed),
]

#: Alignment, components, the CRF and tokenisation are beyond SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
