"""Test-data views over the driver's parquet tables.

The same SQL text defines each view in Spark and in the DuckDB oracle, so
the two sides read identical inputs.  Every view covers its whole source
table: the product, search-query and k-NN query sets are *derived from every
row*, never sampled by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Strict four-level tree; commodity names are unique (they carry the key).
CATALOG_SQL = """
SELECT p_partkey AS commodity_code,
       p_type AS segment_name,
       concat(p_type, ' ', p_brand) AS family_name,
       concat(p_type, ' ', p_brand, ' S', CAST(p_size AS STRING)) AS class_name,
       concat(p_name, ' ', CAST(p_partkey AS STRING)) AS commodity_name
FROM part
"""

# Names collide across branches: exercises the name-keyed hierarchy leak and
# first/last-wins lookups.
CATALOG_RAW_SQL = """
SELECT p_partkey AS commodity_code,
       p_type AS segment_name,
       p_brand AS family_name,
       concat('S', CAST(p_size AS STRING)) AS class_name,
       p_name AS commodity_name
FROM part
"""

# One search query per part.
SEARCH_QUERIES_SQL = """
SELECT p_partkey AS query_id,
       upper(concat(p_name, ' ', CAST(p_size AS STRING), ' GAL ', p_type)) AS search_query,
       concat(p_name, ' ', CAST(p_partkey AS STRING)) AS commodity_name
FROM part
"""

# One noisy upper-case product description per part.
PRODUCTS_SQL = """
SELECT p_partkey AS product_id,
       concat('WHILE SUPPLIES LAST: ', upper(p_brand), ' ', upper(p_name), ' S', CAST(p_size AS STRING), ' ',
              CAST(p_size AS STRING), ' GAL ', CAST(110 + p_partkey % 7 AS STRING), 'V SS ', p_type) AS description,
       concat(p_name, ' ', CAST(p_partkey AS STRING)) AS commodity_name
FROM part
"""

# Products plus literal edge rows: null description, empty description,
# null truth, truth absent from the catalog, truth with odd spacing/case, blanks other than the space.
PRODUCTS_GATE_SQL = (
    PRODUCTS_SQL
    + """
UNION ALL SELECT CAST(-1 AS BIGINT), CAST(NULL AS STRING), 'small ring 0'
UNION ALL SELECT CAST(-2 AS BIGINT), '', 'small ring 0'
UNION ALL SELECT CAST(-3 AS BIGINT), 'RED WIDGET 12 GAL', CAST(NULL AS STRING)
UNION ALL SELECT CAST(-4 AS BIGINT), 'RED WIDGET 12 GAL', 'no such commodity'
UNION ALL SELECT CAST(-5 AS BIGINT), 'BLUE BOLT 5 GAL SMALL', '  Blue Bolt 2 '
UNION ALL SELECT CAST(-6 AS BIGINT), 'SS\u00a0VLV 5 GAL\u3000SMALL', '\u00a0Blue Bolt 2\u3000'
UNION ALL SELECT CAST(-7 AS BIGINT), 'SS\tVLV 5 GAL', '\tBlue Bolt 2\t '
"""
)

# Text retrieval: benchmark passages are the queries, documents the catalog.
DOC_CATALOG_SQL = """
SELECT doc_id, lang, source, text FROM documents
"""

BENCH_QUERIES_SQL = """
SELECT item_id, text FROM benchmark
"""

VIEW_SQL = {
    "catalog": CATALOG_SQL,
    "catalog_raw": CATALOG_RAW_SQL,
    "search_queries": SEARCH_QUERIES_SQL,
    "products": PRODUCTS_SQL,
    "products_gate": PRODUCTS_GATE_SQL,
    "doc_catalog": DOC_CATALOG_SQL,
    "bench_queries": BENCH_QUERIES_SQL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=("part", "documents", "benchmark", "embeddings")) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a named view from its SQL over the parquet tables of ``sf_dir``."""
    register_tables(spark, sf_dir)
    return spark.sql(VIEW_SQL[name])


def oracle_ctes(names) -> str:
    """``WITH`` clause defining the named views for the DuckDB oracle."""
    parts = [f"{n} AS ({VIEW_SQL[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
