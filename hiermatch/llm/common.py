"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, shared_path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage, survives
    lost executors, and gives the planner the real size."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, so other columns cannot clash; null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

