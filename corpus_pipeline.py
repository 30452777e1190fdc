"""The corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet in the shared folder and read again as the next stage's docs. All stages but the last
return the columns of documents.

Defined cases: null and empty texts fail the quality rules and go; a null id goes through like any
other, before all numbers where order counts; of documents with equal texts the one with the least id
stays in the near-duplicate join, and rows of one id stay or go together; texts of any length pass whole; further columns of documents, whatever their
names, are carried to the last stage; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import jaccard, linededup, packing, quality, templates
from waymark.llm.common import persisted, table
from waymark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, and documents of which nothing is left."""
    return linededup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return templates.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", sequences),
]

#: Compression ratios, set joins and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persisted(stage(spark, docs, sf_dir), name)
    return docs
