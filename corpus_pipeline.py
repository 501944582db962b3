"""Preparation of a text corpus in five stages, each an operator of `upswing.llm`.

Every stage gets what its predecessor kept, as a written table, and works on all of it.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from upswing.llm import decontamination, language, near_duplicates, packing, pseudonyms
from upswing.llm.tables import BATCH_ROWS, read, tokenizer_path
from upswing.sources.tables import staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return language.known_language(docs, language.train(docs))


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_duplicates.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates, addresses and keys get pseudonyms."""
    return pseudonyms.pseudonymised(docs, kinds=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, in windows of related ones."""
    return packing.packed(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("language id", known_language),
    ("near duplicates", first_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("pseudonyms", with_pseudonyms),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
