"""Registered profile, text, feature and static-hierarchy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as FE
from ..functions import text as TX
from ..operators import classify as C
from ..operators import hierarchy as H
from ..operators import profile as P
from ..session import shared_path
from ..sources.views import view
from . import oracle as O
from .registry import register


def r6(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


# ---------------------------------------------------------------- P1-P9

@register("p_row_counts", views=("catalog", "search_queries", "products", "doc_catalog"), sql="""
SELECT 'catalog' AS table_name, count(*) AS rows FROM catalog
UNION ALL SELECT 'search_queries', count(*) FROM search_queries
UNION ALL SELECT 'products', count(*) FROM products
UNION ALL SELECT 'documents', count(*) FROM doc_catalog""")
def p_row_counts(spark, sf):
    return P.row_counts({n: view(spark, sf, v) for n, v in (("catalog", "catalog"), ("search_queries", "search_queries"),
                                                            ("products", "products"), ("documents", "doc_catalog"))})


_DOC_COLS = (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))


@register("p_column_profile", sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM documents" for c, t in _DOC_COLS))
def p_column_profile(spark, sf):
    from ..sources.views import table

    return P.column_profile(table(spark, sf, "documents").select(*[c for c, _ in _DOC_COLS]))


@register("p_null_counts", views=("products_gate",), sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls FROM products_gate"
    for c in ("product_id", "description", "commodity_name")))
def p_null_counts(spark, sf):
    return P.null_counts(view(spark, sf, "products_gate"))


@register("p_duplicate_rows", sql="""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM documents GROUP BY lang, source, text)""")
def p_duplicate_rows(spark, sf):
    from ..sources.views import table

    return P.duplicate_rows(table(spark, sf, "documents").select("lang", "source", "text"))


@register("p_distinct_counts", views=("catalog_raw",), sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM catalog_raw"
    for c in ("commodity_code", "segment_name", "family_name", "class_name", "commodity_name")))
def p_distinct_counts(spark, sf):
    return P.distinct_counts(view(spark, sf, "catalog_raw"))


@register("p_corpus_stats", views=("catalog",), sql=f"""
SELECT count(*) AS rows, CAST(round(avg(length(c))) AS BIGINT) AS mean_length, count(c) AS non_null
FROM (SELECT {O.corpus()} AS c FROM catalog)""")
def p_corpus_stats(spark, sf):
    return P.corpus_stats(C.with_corpus(view(spark, sf, "catalog")))


_COVER_SIDE = """
SELECT '{side}' AS side, count(*) AS distinct_names,
       count(*) FILTER (WHERE k IN (SELECT {key} FROM catalog)) AS matched
FROM (SELECT DISTINCT {key} AS k FROM {view} WHERE commodity_name IS NOT NULL)"""


@register("p_key_coverage", views=("catalog", "products_gate", "search_queries"), sql=f"""
SELECT side, distinct_names, matched,
       {O.round6("CASE WHEN distinct_names > 0 THEN matched / distinct_names * 100.0 END")} AS match_rate,
       distinct_names - matched AS missing FROM (
{_COVER_SIDE.format(side="products", view="products_gate", key=O.join_key("commodity_name"))}
UNION ALL {_COVER_SIDE.format(side="queries", view="search_queries", key=O.join_key("commodity_name"))})""")
def p_key_coverage(spark, sf):
    cov = P.key_coverage(view(spark, sf, "catalog"), {"products": view(spark, sf, "products_gate"),
                                                      "queries": view(spark, sf, "search_queries")})
    return cov.select("side", "distinct_names", "matched", r6("match_rate").alias("match_rate"), "missing")


_SKETCHED = ("commodity_code", "segment_name", "family_name", "class_name", "commodity_name")


@register("p_distinct_sketch", views=("catalog_raw",), sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within FROM catalog_raw" for c in _SKETCHED))
def p_distinct_sketch(spark, sf):
    """P5 from sketches that are stored per segment and merged, beside the exact counts: within 4 % of them."""
    raw = view(spark, sf, "catalog_raw")
    path = shared_path(spark, "sketches")
    P.distinct_sketches(raw.withColumn("part", F.col("segment_name")), list(_SKETCHED), ["part"]).write.parquet(path)
    merged = P.sketched_distinct_counts(spark.read.parquet(path))
    exact = P.distinct_counts(raw).withColumnRenamed("n_distinct", "exact")
    return merged.join(exact, "column_name").select("column_name", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.04).alias("within"))


@register("p_key_coverage_sketch", views=("catalog", "products_gate", "search_queries"), sql=f"""
SELECT side, distinct_names, matched, true AS within FROM (
{_COVER_SIDE.format(side="products", view="products_gate", key=O.join_key("commodity_name"))}
UNION ALL {_COVER_SIDE.format(side="queries", view="search_queries", key=O.join_key("commodity_name"))})""")
def p_key_coverage_sketch(spark, sf):
    """P7 by intersecting sketches, beside the exact counts: both numbers within 4 % of the distinct names."""
    cat, sides = view(spark, sf, "catalog"), {"products": view(spark, sf, "products_gate"), "queries": view(spark, sf, "search_queries")}
    near = P.sketched_key_coverage(cat, sides).select("side", F.col("distinct_names").alias("d"), F.col("matched").alias("m"))
    both = P.key_coverage(cat, sides).join(near, "side")
    off = F.greatest(F.abs(F.col("d") - F.col("distinct_names")), F.abs(F.col("m") - F.col("matched")))
    return both.select("side", "distinct_names", "matched", (off <= F.col("distinct_names") * 0.04).alias("within"))


@register("p_missing_keys", views=("catalog", "products_gate"), sql=f"""
SELECT DISTINCT {O.join_key("commodity_name")} AS missing_name FROM products_gate
WHERE commodity_name IS NOT NULL
  AND {O.join_key("commodity_name")} NOT IN (SELECT {O.join_key("commodity_name")} FROM catalog)""")
def p_missing_keys(spark, sf):
    return P.missing_keys(view(spark, sf, "catalog"), view(spark, sf, "products_gate"))


@register("p_compatibility", views=("catalog", "products_gate"), sql=f"""
SELECT count(*) AS total_products, count(DISTINCT k) AS distinct_names,
       count(DISTINCT k) FILTER (WHERE k IN (SELECT {O.join_key("commodity_name")} FROM catalog)) AS matched,
       count(DISTINCT k) FILTER (WHERE k NOT IN (SELECT {O.join_key("commodity_name")} FROM catalog)) AS missing,
       {O.round6("count(DISTINCT k) FILTER (WHERE k IN (SELECT " + O.join_key("commodity_name") + " FROM catalog)) / count(DISTINCT k) * 100.0")} AS match_rate
FROM (SELECT {O.join_key("commodity_name")} AS k FROM products_gate)""")
def p_compatibility(spark, sf):
    r = P.compatibility_report(view(spark, sf, "catalog"), view(spark, sf, "products_gate"))
    return r.withColumn("match_rate", r6("match_rate"))


@register("p_preview", views=("products",), sql="""
SELECT product_id, description FROM products ORDER BY product_id LIMIT 5""")
def p_preview(spark, sf):
    return P.preview(view(spark, sf, "products"), 5, "product_id", ["product_id", "description"])


# ---------------------------------------------------------------- T1-T8

_CAT_NULLS = """catalog_n AS (
  SELECT commodity_code, segment_name, family_name, class_name, commodity_name FROM catalog
  UNION ALL SELECT CAST(-1 AS BIGINT), 'SEG', CAST(NULL AS STRING), 'CLS', 'name -1'
  UNION ALL SELECT CAST(-2 AS BIGINT), 'Seg Two', 'Fam', 'Cls', CAST(NULL AS STRING))"""


@register("t_corpus", views=("catalog",), sql=f"""WITH {_CAT_NULLS}
SELECT commodity_code, {O.corpus()} AS corpus FROM catalog_n""")
def t_corpus(spark, sf):
    view(spark, sf, "catalog").createOrReplaceTempView("catalog")
    c = spark.sql(f"WITH {_CAT_NULLS} SELECT * FROM catalog_n")
    return c.select("commodity_code", TX.corpus("segment_name", "family_name", "class_name", "commodity_name")
                    .alias("corpus"))


@register("t_key", views=("products_gate",), sql=f"""
SELECT product_id, {O.join_key("commodity_name")} AS name_key FROM products_gate""")
def t_key(spark, sf):
    return view(spark, sf, "products_gate").select("product_id", TX.join_key("commodity_name").alias("name_key"))


_TEXTS = """texts AS (
  SELECT 'p' AS src, product_id AS id, description AS text FROM products_gate
  UNION ALL SELECT 'd', doc_id, text FROM doc_catalog)"""


def _texts(spark, sf):
    view(spark, sf, "products_gate").createOrReplaceTempView("products_gate")
    view(spark, sf, "doc_catalog").createOrReplaceTempView("doc_catalog")
    return spark.sql(f"WITH {_TEXTS} SELECT * FROM texts")


@register("t_clean_substring", views=("products_gate", "doc_catalog"), sql=f"""WITH {_TEXTS}
SELECT src, id, {O.clean("text")} AS cleaned FROM texts""")
def t_clean_substring(spark, sf):
    return _texts(spark, sf).select("src", "id", TX.clean("text").alias("cleaned"))


@register("t_clean_drop_runs", views=("products_gate",), sql=f"""
SELECT product_id, {O.clean("description", drop_runs=8)} AS cleaned FROM products_gate""")
def t_clean_drop_runs(spark, sf):
    return view(spark, sf, "products_gate").select("product_id", TX.clean("description", drop_runs=8).alias("cleaned"))


_TOKMAP = ("CASE " + " ".join(f"WHEN t = {O.q(k)} THEN {O.q(v)}" for k, v in TX.TOKEN_MAP) + " ELSE t END")


@register("t_clean_token_map", views=("products_gate", "doc_catalog"), sql=f"""WITH {_TEXTS}
SELECT src, id, trim(regexp_replace(regexp_replace(array_to_string(list_transform(
         {O.tokens("lower(text)")}, lambda t: {_TOKMAP}), ' '), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))
       AS cleaned FROM texts""")
def t_clean_token_map(spark, sf):
    return _texts(spark, sf).select("src", "id", TX.clean_tokens("text").alias("cleaned"))


@register("t_clean_column", views=("products",), sql=f"""
SELECT product_id, description, commodity_name, {O.clean("description")} AS description_clean FROM products""")
def t_clean_column(spark, sf):
    return TX.with_clean(view(spark, sf, "products"), "description", "description_clean")


@register("t_name_key", views=("products_gate",), sql=f"""
SELECT product_id, {O.name_key_ascii("commodity_name")} AS name_key FROM products_gate""")
def t_name_key(spark, sf):
    return view(spark, sf, "products_gate").select("product_id", TX.name_key("commodity_name").alias("name_key"))


@register("t_tokens", views=("products_gate",), sql=f"""
SELECT product_id, {O.clean_tokens("description")} AS tokens FROM products_gate""")
def t_tokens(spark, sf):
    return view(spark, sf, "products_gate").select("product_id", TX.clean_token_list("description").alias("tokens"))


# ---------------------------------------------------------------- F1-F5, F8

_FEAT_TEXTS = """ftexts AS (
  SELECT 'p' AS src, product_id AS id, description AS text FROM products_gate
  UNION ALL SELECT 'c', commodity_code, lower(segment_name || ' ' || family_name || ' ' || class_name || ' ' ||
                                              commodity_name) FROM catalog)"""


def _ftexts(spark, sf):
    view(spark, sf, "products_gate").createOrReplaceTempView("products_gate")
    c = C.with_corpus(view(spark, sf, "catalog"))
    p = view(spark, sf, "products_gate").select(F.lit("p").alias("src"), F.col("product_id").alias("id"),
                                                F.col("description").alias("text"))
    return p.unionByName(c.select(F.lit("c").alias("src"), F.col("commodity_code").alias("id"), F.col("corpus").alias("text")))


@register("f_materials", views=("products_gate", "catalog"), sql=f"""WITH {_FEAT_TEXTS}
SELECT src, id, {", ".join(O.material_cols("text"))} FROM ftexts""")
def f_materials(spark, sf):
    return _ftexts(spark, sf).select("src", "id", *FE.material_flags("text"))


@register("f_specs", views=("products_gate", "catalog"), sql=f"""WITH {_FEAT_TEXTS}
SELECT src, id, {", ".join(O.spec_cols("text"))} FROM ftexts""")
def f_specs(spark, sf):
    return _ftexts(spark, sf).select("src", "id", *FE.spec_values("text"))


@register("f_keywords", views=("products_gate", "catalog"), sql=f"""WITH {_FEAT_TEXTS}
SELECT src, id, {", ".join(O.keyword_cols("text"))} FROM ftexts""")
def f_keywords(spark, sf):
    return _ftexts(spark, sf).select("src", "id", *FE.keyword_flags("text"))


@register("f_vector", views=("products_gate", "catalog"), sql=f"""WITH {_FEAT_TEXTS}
SELECT src, id, {O.feature_vector("text")} AS features FROM ftexts""")
def f_vector(spark, sf):
    return _ftexts(spark, sf).select("src", "id", FE.feature_vector("text").alias("features"))


@register("f_catalog_by_name", views=("catalog_raw",), sql=f"""
SELECT commodity_name, arg_max({O.feature_vector(O.corpus())}, commodity_code) AS cat_features
FROM catalog_raw GROUP BY commodity_name""")
def f_catalog_by_name(spark, sf):
    return C.catalog_features(view(spark, sf, "catalog_raw"))


@register("f_dimensions", views=("products_gate", "doc_catalog"), sql=f"""WITH {_TEXTS}
SELECT src, id,
  CASE WHEN regexp_extract(coalesce(text, ''), {O.q(FE.DIMENSION)}, 1, 'i') <> ''
       THEN TRY_CAST(regexp_extract(coalesce(text, ''), {O.q(FE.DIMENSION)}, 1, 'i') AS DOUBLE) END AS dim_a,
  CASE WHEN regexp_extract(coalesce(text, ''), {O.q(FE.DIMENSION)}, 2, 'i') <> ''
       THEN TRY_CAST(regexp_extract(coalesce(text, ''), {O.q(FE.DIMENSION)}, 2, 'i') AS DOUBLE) END AS dim_b
FROM texts""")
def f_dimensions(spark, sf):
    return _texts(spark, sf).select("src", "id", *FE.dimensions("text"))


# ---------------------------------------------------------------- H1, H2, H7 (static)

@register("h_edges", views=("catalog_raw",), sql="""
SELECT DISTINCT 'segment_family' AS level, segment_name AS parent, family_name AS child FROM catalog_raw
UNION ALL SELECT DISTINCT 'family_class', family_name, class_name FROM catalog_raw
UNION ALL SELECT DISTINCT 'class_commodity', class_name, commodity_name FROM catalog_raw""")
def h_edges(spark, sf):
    return H.edge_table(view(spark, sf, "catalog_raw"))


@register("h_level_counts", views=("catalog", "catalog_raw"), sql="""
SELECT 'strict' AS catalog_kind, count(DISTINCT segment_name) AS segments, count(DISTINCT family_name) AS families,
       count(DISTINCT class_name) AS classes, count(DISTINCT commodity_name) AS commodities FROM catalog
UNION ALL
SELECT 'raw', count(DISTINCT segment_name), count(DISTINCT family_name), count(DISTINCT class_name),
       count(DISTINCT commodity_name) FROM catalog_raw""")
def h_level_counts(spark, sf):
    a = H.level_counts(view(spark, sf, "catalog")).select(F.lit("strict").alias("catalog_kind"), "*")
    b = H.level_counts(view(spark, sf, "catalog_raw")).select(F.lit("raw").alias("catalog_kind"), "*")
    return a.unionByName(b)


@register("h_reverse", views=("catalog_raw",), sql="""
SELECT commodity_name, arg_max(segment_name, commodity_code) AS segment_name,
       arg_max(family_name, commodity_code) AS family_name, arg_max(class_name, commodity_code) AS class_name
FROM catalog_raw GROUP BY commodity_name""")
def h_reverse(spark, sf):
    return H.reverse_lookup(view(spark, sf, "catalog_raw"))


@register("h_reach_raw", views=("catalog_raw",), sql="""
WITH sf AS (SELECT DISTINCT segment_name AS p, family_name AS c FROM catalog_raw),
fc AS (SELECT DISTINCT family_name AS p, class_name AS c FROM catalog_raw),
cc AS (SELECT DISTINCT class_name AS p, commodity_name AS c FROM catalog_raw)
SELECT DISTINCT sf.p AS segment_name, cc.c AS commodity_name FROM sf JOIN fc ON sf.c = fc.p JOIN cc ON fc.c = cc.p""")
def h_reach_raw(spark, sf):
    """H7 static closure on the leaky catalog: a name reaches every segment sharing its family/class names."""
    return H.reach(view(spark, sf, "catalog_raw"))
