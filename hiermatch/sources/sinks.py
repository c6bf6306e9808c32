"""Sinks (S4, S6-S10).

All writers are distributed DataFrame writes (one file per task); nothing
is gathered on the driver.  Output folders for ad-hoc runs live under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embed import DIM, hash_embed
from ..session import shared_path


#: CSV in which every string comes back as it was: null and the empty string are told apart, blanks are kept.
NULL_MARK = "\x01N"
EXACT_CSV = {"header": "true", "quote": '"', "escape": '"', "nullValue": NULL_MARK,
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, removed when the session ends."""
    return shared_path(spark, name)


def build_vector_table(catalog: DataFrame, path: str, dim: int = DIM, embedding: DataFrame | None = None,
                       rows_per_file: int = 1_000_000) -> DataFrame:
    """One (doc_id, corpus, metadata, embedding) row per catalog entry, written as parquet.

    ``embedding`` may supply (doc_id, embedding) from a model job; the default is the
    built-in hashed embedding of the raw corpus.  Returns the written table.
    """
    base = catalog.select(
        F.col("commodity_code").alias("doc_id"), "corpus",
        F.struct("segment_name", "family_name", "class_name", "commodity_name").alias("metadata"))
    if embedding is None:
        out = base.withColumn("embedding", hash_embed("corpus", dim))
    else:
        out = base.join(embedding, "doc_id")
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return catalog.sparkSession.read.schema(out.schema).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines (one object per row)."""
    df.write.mode("overwrite").json(path)


def write_predictions_csv(nested: DataFrame, path: str) -> None:
    """CSV with a header; the nested prediction list is serialised with ``to_json``.  Null is ``NULL_MARK``,
    an empty string is empty; :func:`readers.read_predictions_csv` brings both back."""
    flat = nested.withColumn("top_k_predictions", F.to_json("top_k_predictions"))
    flat.write.mode("overwrite").options(**EXACT_CSV, emptyValue='""').csv(path)


def write_predictions_parquet(nested: DataFrame, path: str) -> None:
    """S8 native form: parquet keeps the nested column typed."""
    nested.write.mode("overwrite").parquet(path)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """The one-row metrics table as CSV with a header."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """RFC-4180 CSV (quote-doubling escape), readable by the S1-S3 readers."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
