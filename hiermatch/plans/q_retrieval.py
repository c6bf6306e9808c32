"""Registered retrieval queries: lexical (R1-R3, R12), vectors (R4-R9), text truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.embed import DIM, hash_embed
from ..functions.text import clean, corpus
from ..operators import containment, evaluate, lexical, segments, vectors
from ..session import shared_path
from ..sources.views import table, view
from . import oracle as O
from .registry import register


def r6(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


def doc_index(spark, sf):
    return lexical.build_stored_index(view(spark, sf, "doc_catalog"), "doc_id", "text")


def catalog_with_corpus(spark, sf, name="catalog"):
    c = view(spark, sf, name)
    return c.withColumn("corpus", corpus("segment_name", "family_name", "class_name", "commodity_name"))


# ---------------------------------------------------------------- lexical

_BM25_DOCS = O.bm25_ctes("doc_catalog", "doc_id", "text", "bench_queries", "item_id", "text")


@register("r_postings", views=("doc_catalog",), sql=f"""
WITH {O.bm25_ctes("doc_catalog", "doc_id", "text", "bench_queries", "item_id", "text").strip()}
SELECT token, doc_id, CAST(tf AS BIGINT) AS tf, CAST(dl AS INTEGER) AS dl FROM post
""")
def r_postings(spark, sf):
    p = lexical.postings(view(spark, sf, "doc_catalog"), "doc_id", "text")
    return p.select("token", "doc_id", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("int").alias("dl"))


@register("r_idf", views=("doc_catalog",), sql=f"""
WITH {_BM25_DOCS.strip()}
SELECT token, CAST(df AS BIGINT) AS df, {O.round6("idf")} AS idf FROM idf
""")
def r_idf(spark, sf):
    idx = doc_index(spark, sf)
    return idx.idf.select("token", F.col("df").cast("long").alias("df"), r6("idf").alias("idf"))


_BM25_TOP_SQL = f"""
WITH {_BM25_DOCS.strip()}
SELECT query_id, doc_id, {O.round6("score")} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10
"""


@register("r_bm25_topk", views=("doc_catalog", "bench_queries"), sql=_BM25_TOP_SQL)
def r_bm25_topk(spark, sf):
    idx = doc_index(spark, sf)
    top = lexical.bm25_topk(view(spark, sf, "bench_queries"), "item_id", "text", idx, 10)
    return top.select("query_id", "doc_id", r6("score").alias("score"), F.col("rank").cast("int").alias("rank"))


@register("r_bm25_segments", views=("doc_catalog", "bench_queries"), sql=_BM25_TOP_SQL)
def r_bm25_segments(spark, sf):
    """The same top ten from a stored index that got the documents in two appends, one half of the languages each."""
    docs, path = view(spark, sf, "doc_catalog"), shared_path(spark, "segmented-index")
    first = F.coalesce(F.col("lang") < "es", F.lit(False))
    segments.add_segment(docs.where(first), "doc_id", "text", path)
    segments.add_segment(docs.where(~first), "doc_id", "text", path)
    top = segments.bm25_topk_segments(view(spark, sf, "bench_queries"), "item_id", "text", segments.open_segments(spark, path), 10)
    return top.select("query_id", "doc_id", r6("score").alias("score"), F.col("rank").cast("int").alias("rank"))


_NAME_ONLY = O.bm25_ctes("catalog", "commodity_code", "commodity_name", "search_queries", "query_id",
                         "search_query", tok=O.split_tokens)


@register("r_bm25_name_only", views=("catalog", "search_queries"), sql=f"""
WITH {_NAME_ONLY.strip()}
SELECT query_id, doc_id AS commodity_code, {O.round6("score")} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10
""")
def r_bm25_name_only(spark, sf):
    cat = view(spark, sf, "catalog")
    idx = lexical.build_stored_index(cat, "commodity_code", "commodity_name", tokenizer=lexical.split_tokens)
    top = lexical.bm25_topk(view(spark, sf, "search_queries"), "query_id", "search_query", idx, 10,
                            tokenizer=lexical.split_tokens)
    return top.select("query_id", F.col("doc_id").alias("commodity_code"), r6("score").alias("score"),
                      F.col("rank").cast("int").alias("rank"))


# ---------------------------------------------------------------- text truth + flagship metrics


@register("r_text_truth", views=("doc_catalog", "bench_queries"), sql="""
SELECT b.item_id, min(d.doc_id) AS true_doc
FROM bench_queries b JOIN doc_catalog d ON contains(d.text, b.text) GROUP BY b.item_id
""")
def r_text_truth(spark, sf):
    return containment.first_containing(view(spark, sf, "bench_queries"), view(spark, sf, "doc_catalog"))


_TEXT_METRICS_SQL = f"""
WITH {_BM25_DOCS.strip()},
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
        FROM scores) WHERE rank <= 10),
truth AS (SELECT b.item_id AS query_id, min(d.doc_id) AS true_doc
          FROM bench_queries b JOIN doc_catalog d ON contains(d.text, b.text) GROUP BY b.item_id),
hits AS (SELECT t.query_id, min(p.rank) AS hit_rank FROM truth t LEFT JOIN top p
         ON p.query_id = t.query_id AND p.doc_id = t.true_doc GROUP BY t.query_id)
SELECT count(*) AS queries,
       {O.round6("coalesce(avg(coalesce(1.0 / hit_rank, 0.0)), 0.0)")} AS mrr,
       {", ".join(
           f'{O.round6(f"avg(CASE WHEN hit_rank <= {k} THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_{k}, '
           f'{O.round6(f"avg(CASE WHEN hit_rank <= {k} THEN 1.0 ELSE 0.0 END / {k})")} AS precision_at_{k}, '
           f'{O.round6(f"avg(CASE WHEN hit_rank <= {k} THEN 1.0 / log2(hit_rank + 1.0) ELSE 0.0 END)")} AS ndcg_at_{k}'
           for k in (1, 5, 10))}
FROM hits
"""


def text_retrieval_metrics(spark, sf):
    idx = doc_index(spark, sf)
    top = lexical.bm25_topk(view(spark, sf, "bench_queries"), "item_id", "text", idx, 10)
    truth = containment.first_containing(view(spark, sf, "bench_queries"), view(spark, sf, "doc_catalog")) \
        .withColumnRenamed("item_id", "query_id")
    m = evaluate.retrieval_metrics(top, truth)
    return m.select(*[r6(c).alias(c) if c != "queries" else F.col(c) for c in m.columns])


register("e_text_retrieval", views=("doc_catalog", "bench_queries"), sql=_TEXT_METRICS_SQL)(text_retrieval_metrics)


# ---------------------------------------------------------------- vectors

_EMB_SQL = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
_KNN_PAIRS = f"""
WITH e AS ({_EMB_SQL}),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
             list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), doc_id) AS rank FROM d)
"""


def _knn_embeddings(spark, sf, k=10):
    e = table(spark, sf, "embeddings")
    return vectors.knn(e, e, k, qid="vec_id", cid="vec_id", exclude_self=True)


@register("r_knn_topk", sql=_KNN_PAIRS + f"""
SELECT query_id, doc_id, {O.round6("distance")} AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10
""")
def r_knn_topk(spark, sf):
    t = _knn_embeddings(spark, sf)
    return t.select("query_id", "doc_id", r6("distance").alias("distance"), F.col("rank").cast("int").alias("rank"))


@register("r_knn_block", sql=_KNN_PAIRS + f"""
SELECT query_id, doc_id, {O.round6("distance")} AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 25
""")
def r_knn_block(spark, sf):
    # Small blocks and slices force many cells.
    e = table(spark, sf, "embeddings")
    t = vectors.knn(e, e, 25, qid="vec_id", cid="vec_id", exclude_self=True, query_block_rows=64,
                    catalog_block_rows=96)
    return t.select("query_id", "doc_id", r6("distance").alias("distance"), F.col("rank").cast("int").alias("rank"))


@register("r_similarity", sql=_KNN_PAIRS + f"""
SELECT query_id, doc_id, {O.round6("1.0 / (1.0 + distance)")} AS similarity, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= 10
""")
def r_similarity(spark, sf):
    t = _knn_embeddings(spark, sf)
    return t.select("query_id", "doc_id", r6(vectors.similarity(F.col("distance"))).alias("similarity"),
                    F.col("rank").cast("int").alias("rank"))


@register("r_knn_distance", sql=_KNN_PAIRS + f"""
SELECT query_id, doc_id, {O.round6("sqrt(distance)")} AS l2_distance, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= 5
""")
def r_knn_distance(spark, sf):
    e = table(spark, sf, "embeddings")
    t = vectors.knn(e, e, 5, qid="vec_id", cid="vec_id", exclude_self=True, squared=False)
    return t.select("query_id", "doc_id", r6("distance").alias("l2_distance"), F.col("rank").cast("int").alias("rank"))


@register("r_knn_relevance", sql=_KNN_PAIRS + f"""
SELECT query_id, doc_id, {O.round6("1.0 - distance / sqrt(2.0)")} AS relevance, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= 10
""")
def r_knn_relevance(spark, sf):
    t = _knn_embeddings(spark, sf)
    return t.select("query_id", "doc_id", r6(vectors.relevance(F.col("distance"))).alias("relevance"),
                    F.col("rank").cast("int").alias("rank"))


@register("e_knn_label", sql=_KNN_PAIRS + f""",
lab AS (SELECT vec_id, label FROM embeddings),
h AS (SELECT r.query_id, min(CASE WHEN lq.label = ld.label THEN r.rank END) AS hit_rank,
             sum(CASE WHEN lq.label = ld.label AND r.rank <= 5 THEN 1 ELSE 0 END) AS same5
      FROM r JOIN lab lq ON lq.vec_id = r.query_id JOIN lab ld ON ld.vec_id = r.doc_id
      WHERE r.rank <= 10 GROUP BY r.query_id)
SELECT count(*) AS queries, {O.round6("avg(CASE WHEN hit_rank = 1 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_1,
       {O.round6("avg(CASE WHEN hit_rank <= 5 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_5,
       {O.round6("avg(same5 / 5.0)")} AS precision_at_5,
       {O.round6("avg(coalesce(1.0 / hit_rank, 0.0))")} AS mrr
FROM h
""")
def e_knn_label(spark, sf):
    """k-NN quality on the embeddings table: a neighbour is relevant when it shares the query's label."""
    e = table(spark, sf, "embeddings")
    t = _knn_embeddings(spark, sf)
    lab = e.select("vec_id", "label")
    j = (t.join(lab.withColumnRenamed("vec_id", "query_id").withColumnRenamed("label", "lq"), "query_id")
         .join(lab.withColumnRenamed("vec_id", "doc_id").withColumnRenamed("label", "ld"), "doc_id"))
    same = F.col("lq") == F.col("ld")
    h = j.groupBy("query_id").agg(F.min(F.when(same, F.col("rank"))).alias("hit_rank"),
                                  F.sum(F.when(same & (F.col("rank") <= 5), 1).otherwise(0)).alias("same5"))
    return h.agg(
        F.count(F.lit(1)).alias("queries"),
        r6(F.avg(F.when(F.col("hit_rank") == 1, 1.0).otherwise(0.0))).alias("accuracy_at_1"),
        r6(F.avg(F.when(F.col("hit_rank") <= 5, 1.0).otherwise(0.0))).alias("accuracy_at_5"),
        r6(F.avg(F.col("same5") / 5.0)).alias("precision_at_5"),
        r6(F.avg(F.coalesce(1.0 / F.col("hit_rank"), F.lit(0.0)))).alias("mrr"),
    )


@register("r_knn_lsh")
def r_knn_lsh(spark, sf):
    e = table(spark, sf, "embeddings")
    t = vectors.knn_lsh(e, e, 10, qid="vec_id", cid="vec_id", exclude_self=True)
    return t.select("query_id", "doc_id", r6("distance").alias("distance"), F.col("rank").cast("int").alias("rank"))


@register("r_hash_embed", views=("products",), sql=f"""
SELECT product_id, list_transform(v, lambda x: round(x, 6) + 0.0) AS embedding FROM (
  SELECT product_id, list_transform(c, lambda x: CASE WHEN n > 0 THEN x / n ELSE 0.0 END) AS v FROM (
    SELECT product_id, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS n FROM (
      SELECT product_id, {O.hash_embed(O.clean("description"), DIM)} AS c FROM products)))
""")
def r_hash_embed(spark, sf):
    p = view(spark, sf, "products")
    v = hash_embed(clean("description"), DIM)
    return p.select("product_id", F.transform(v, lambda x: F.round(x, 6) + F.lit(0.0)).alias("embedding"))
