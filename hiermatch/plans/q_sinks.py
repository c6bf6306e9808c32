"""Registered source/sink round trips (S1-S10): write with the sink, read back, compare content."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import classify as C
from ..sources import readers, sinks
from ..sources.views import view
from . import oracle as O
from . import q_evaluate, q_training
from .registry import register


@register("s_csv_roundtrip", views=("products",), sql="""
SELECT description, commodity_name FROM products""")
def s_csv_roundtrip(spark, sf):
    """S3: product CSV written with RFC-4180 quoting and read back."""
    p = view(spark, sf, "products").select(
        F.col("description").alias("Original Description"), F.col("commodity_name").alias("UNSPSC Commodity Name"))
    path = sinks.scratch_path(spark, "products-csv")
    sinks.write_csv(p, path)
    return readers.read_products(spark, path).select("description", "commodity_name")


@register("s_csv_line_breaks", views=("products",), sql="""
SELECT product_id, replace(description, ': ', ':' || chr(10)) || chr(10) || '"' || commodity_name || '",' AS description, commodity_name FROM products""")
def s_csv_line_breaks(spark, sf):
    """Descriptions with line breaks and quotes, read back by several tasks per file."""
    broken = F.concat(F.replace("description", F.lit(": "), F.lit(":\n")), F.lit('\n"'), F.col("commodity_name"), F.lit('",'))
    p = view(spark, sf, "products").select(F.col("product_id").cast("string").alias("product_id"), broken.alias("Original Description"), F.col("commodity_name").alias("UNSPSC Commodity Name"))
    path = sinks.scratch_path(spark, "broken-csv")
    sinks.write_csv(p, path)
    header = (("product_id", "product_id", T.LongType()), *readers.PRODUCTS_HEADER)
    return readers.read_csv(spark, path, header, multi_line=True).select("product_id", "description", "commodity_name")


@register("s_queries_csv", views=("search_queries",), sql="""
SELECT search_query, commodity_name FROM search_queries""")
def s_queries_csv(spark, sf):
    """Search queries, columns in another order than the reader's, read back by header name."""
    q = view(spark, sf, "search_queries").select(
        F.col("commodity_name").alias("UNSPSC Commodity Name"), F.col("search_query").alias("Search Query"))
    path = sinks.scratch_path(spark, "queries-csv")
    sinks.write_csv(q, path)
    return readers.read_queries(spark, path).select("search_query", "commodity_name")


@register("s_catalog_csv", views=("catalog",), sql=f"""
SELECT commodity_code, commodity_name, {O.corpus()} AS corpus FROM catalog""")
def s_catalog_csv(spark, sf):
    """Catalog CSV with the reference's header, read back with corpus derived."""
    c = view(spark, sf, "catalog")
    out = c.select(
        F.lit(1).cast("long").alias("Segment Code"), F.col("segment_name").alias("Segment Name"),
        F.lit(2).cast("long").alias("Family Code"), F.col("family_name").alias("Family Name"),
        F.lit(3).cast("long").alias("Class Code"), F.col("class_name").alias("Class Name"),
        F.col("commodity_code").alias("Commodity Code"), F.col("commodity_name").alias("Commodity Name"))
    path = sinks.scratch_path(spark, "catalog-csv")
    sinks.write_csv(out, path)
    return readers.read_catalog(spark, path).select("commodity_code", "commodity_name", "corpus")


@register("s_vector_table", views=("catalog",), sql=f"""
SELECT commodity_code AS doc_id, {O.corpus()} AS corpus, segment_name, list_transform({O.l2norm_sql("c")}, lambda x: round(x, 6) + 0.0) AS embedding
FROM (SELECT *, {O.hash_embed(O.corpus(), 64)} AS c FROM catalog)""")
def s_vector_table(spark, sf):
    """S4 + S5: build the vector table as parquet, load it back."""
    path = sinks.scratch_path(spark, "vectors")
    sinks.build_vector_table(C.with_corpus(view(spark, sf, "catalog")), path)
    t = readers.load_vector_table(spark, path)
    return t.select("doc_id", "corpus", F.col("metadata.segment_name").alias("segment_name"),
                    F.transform("embedding", lambda x: F.round(x, 6) + F.lit(0.0)).alias("embedding"))


_TRIPLE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("query_id", T.LongType()), ("query", T.StringType()), ("positive", T.StringType()),
    ("negative", T.StringType()), ("positive_commodity", T.StringType()), ("negative_commodity", T.StringType()),
    ("pick", T.IntegerType()))])


@register("s_json_triples", views=("catalog", "search_queries"), sql=q_training._TRIPLES_SQL)
def s_json_triples(spark, sf):
    """Training triples as JSON lines."""
    t = q_training.g_hard_triples(spark, sf)
    path = sinks.scratch_path(spark, "triples")
    sinks.write_jsonl(t, path)
    return spark.read.schema(_TRIPLE_SCHEMA).json(path)


_PAIR_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("query_id", T.LongType()), ("query", T.StringType()), ("document", T.StringType()),
    ("label", T.IntegerType()), ("commodity", T.StringType()), ("pick", T.IntegerType()))])


@register("s_json_pairs", views=("catalog", "search_queries"), sql=q_training._PAIRS_SQL)
def s_json_pairs(spark, sf):
    """Labelled pairs as JSON lines."""
    t = q_training.g_pairs(spark, sf)
    path = sinks.scratch_path(spark, "pairs")
    sinks.write_jsonl(t, path)
    return spark.read.schema(_PAIR_SCHEMA).json(path)


@register("s_json_mined", views=("catalog", "search_queries"), sql=q_training._MINED_SQL)
def s_json_mined(spark, sf):
    """Retrieval-mined triplets as JSON lines."""
    t = q_training.g_mined_triplets(spark, sf)
    path = sinks.scratch_path(spark, "mined")
    sinks.write_jsonl(t, path)
    schema = "query string, positive string, negatives array<string>"
    return spark.read.schema(schema).json(path)


_PREDICTIONS_SQL = "WITH " + q_evaluate._LEX_PREDS_SQL.strip() + f"""
SELECT p.product_id, p.description, p.commodity_name AS ground_truth, pr.rank, pr.commodity_code, c.commodity_name,
       {O.round6("pr.score")} AS score, c.segment_name AS segment, c.family_name AS family, c.class_name AS class, false AS in_hierarchy
FROM products_gate p LEFT JOIN preds pr ON pr.product_id = p.product_id LEFT JOIN catalog c ON c.commodity_code = pr.commodity_code"""


def _nested(spark, sf):
    cat = view(spark, sf, "catalog").select(
        "commodity_code", "commodity_name", F.col("segment_name").alias("segment"), F.col("family_name").alias("family"),
        F.col("class_name").alias("class"), F.lit(False).alias("in_hierarchy"))
    return C.nest(q_evaluate.lex_preds(spark, sf).join(cat, "commodity_code"), view(spark, sf, "products_gate"))


def _flat(nested):
    rows = nested.select("product_id", "description", "ground_truth", F.explode_outer("top_k_predictions").alias("p"))
    return rows.select("product_id", "description", "ground_truth", "p.*").withColumn("score", F.round("score", 6) + F.lit(0.0)).withColumn(
        "in_hierarchy", F.coalesce("in_hierarchy", F.lit(False)))


@register("s_predictions_csv", views=q_evaluate.VIEWS, sql=_PREDICTIONS_SQL)
def s_predictions_csv(spark, sf):
    """Nested predictions -> CSV (``to_json`` column) -> whole records parsed back, null and empty strings apart."""
    path = sinks.scratch_path(spark, "predictions")
    sinks.write_predictions_csv(_nested(spark, sf), path)
    return _flat(readers.read_predictions_csv(spark, path))


@register("s_predictions_parquet", views=q_evaluate.VIEWS, sql=_PREDICTIONS_SQL)
def s_predictions_parquet(spark, sf):
    """S8, native form: nested predictions -> Parquet -> whole records read back."""
    path = sinks.scratch_path(spark, "predictions-parquet")
    sinks.write_predictions_parquet(_nested(spark, sf), path)
    return _flat(spark.read.parquet(path))


@register("s_metrics_csv", views=q_evaluate.VIEWS, sql=q_evaluate._METRICS + "\nSELECT * FROM mrow")
def s_metrics_csv(spark, sf):
    """The metrics row written as CSV and read back with its schema."""
    m = q_evaluate.e_metrics_row(spark, sf)
    path = sinks.scratch_path(spark, "metrics")
    sinks.write_metrics_csv(m, path)
    return spark.read.schema(m.schema).option("header", True).csv(path)

