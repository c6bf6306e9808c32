"""From raw documents to packed training batches, stage by stage.

Each stage is written as Parquet and read again as the next one's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hiermatch.llm.common import save, table
from hiermatch.llm.contamination import decontaminate
from hiermatch.llm.exact import keep_first
from hiermatch.llm.packing import pack
from hiermatch.llm.quality import keep_good
from hiermatch.llm.simhash import keep_apart


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go; null and empty texts are scored like any other, equal texts alike."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays, null ids last; null and empty texts are equal."""
    return keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash (3-word shingles, 3 bits) the one with the smallest id stays, null ids last and
    ties by digest of the text; different texts under one id are different documents."""
    return keep_apart(docs, shingle=3, distance=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text holds a benchmark item go, whatever their id."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), n=5, threshold=0.8)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its length bucket, batch and place; null and repeated ids keep a row each."""
    return pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The classifier's trees and the packing's dynamic program have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
