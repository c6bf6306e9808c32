"""Readers (S1-S3, S5) with explicit schemas.

The CSV files are RFC-4180: fields hold doubled quotes, so the escape character must be the quote itself
(Spark's default backslash escape mis-parses such rows).  Columns are taken by header name, whatever their
order, and mapped to snake_case; every file of a folder must have the same header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import corpus
from ..operators.position import ROW_POS
from . import csv_blocks
from .sinks import EXACT_CSV

# The CSV headers.
CATALOG_HEADER = (
    ("Segment Code", "segment_code", T.LongType()),
    ("Segment Name", "segment_name", T.StringType()),
    ("Family Code", "family_code", T.LongType()),
    ("Family Name", "family_name", T.StringType()),
    ("Class Code", "class_code", T.LongType()),
    ("Class Name", "class_name", T.StringType()),
    ("Commodity Code", "commodity_code", T.LongType()),
    ("Commodity Name", "commodity_name", T.StringType()),
)
QUERIES_HEADER = (("Search Query", "search_query", T.StringType()),
                  ("UNSPSC Commodity Name", "commodity_name", T.StringType()))
PRODUCTS_HEADER = (("Original Description", "description", T.StringType()),
                   ("UNSPSC Commodity Name", "commodity_name", T.StringType()))

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST", "enforceSchema": "false"}


def read_csv(spark: SparkSession, path: str, header, multi_line: bool) -> DataFrame:
    """The columns of ``header`` by name, plus ``row_pos``: (file, start of the part of it, row number there),
    which orders the rows as the files have them.

    Large files are split over tasks.  With ``multi_line`` quoted line breaks are read too (:mod:`csv_blocks`);
    without it they fail the read.
    """
    columns = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(path).columns
    missing = [src for src, _, _ in header if src not in columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; it has {', '.join(columns)}")
    if multi_line:
        df = csv_blocks.read_csv(spark, path, columns, CSV_OPTIONS)
        pos = F.struct("file", "start", "nth")
    else:
        df = spark.read.options(**CSV_OPTIONS).csv(path)
        pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("nth"))
    return df.select(*[F.col(f"`{src}`").cast(t).alias(dst) for src, dst, t in header], pos.alias(ROW_POS))


def _with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A row id from the row's position, the same in every read of the same files."""
    return df.withColumn(name, F.xxhash64(f"{ROW_POS}.file", f"{ROW_POS}.start", f"{ROW_POS}.nth"))


def read_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Catalog CSV plus the derived ``corpus`` (null when any level name is null)."""
    df = read_csv(spark, path, CATALOG_HEADER, multi_line)
    return df.withColumn("corpus", corpus("segment_name", "family_name", "class_name", "commodity_name"))


def read_queries(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Search-query CSV with a generated ``query_id``."""
    return _with_row_id(read_csv(spark, path, QUERIES_HEADER, multi_line), "query_id")


def read_products(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S3: product CSV with a generated ``product_id``."""
    return _with_row_id(read_csv(spark, path, PRODUCTS_HEADER, multi_line), "product_id")


VECTOR_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("segment_name", T.StringType()),
        T.StructField("family_name", T.StringType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("commodity_name", T.StringType()),
    ])),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
])


def load_vector_table(spark: SparkSession, path: str) -> DataFrame:
    """The persisted vector table (its row count is one cheap parquet-metadata aggregate)."""
    return spark.read.schema(VECTOR_SCHEMA).parquet(path)


PREDICTIONS = "array<struct<rank:int,commodity_code:long,commodity_name:string,score:double,segment:string,family:string,class:string,in_hierarchy:boolean>>"


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`sinks.write_predictions_csv` wrote: product_id, description, top_k_predictions
    (array of records, null if the product has none), ground_truth."""
    flat = spark.read.schema("product_id long, description string, top_k_predictions string, ground_truth string").options(
        **EXACT_CSV, emptyValue="", multiLine="true", mode="FAILFAST", enforceSchema="false").csv(path)
    return flat.withColumn("top_k_predictions", F.from_json("top_k_predictions", PREDICTIONS))
