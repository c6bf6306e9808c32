"""Registered classification queries: fuse, re-score, boost, blend, classify."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.embed import hash_embed
from ..functions.text import clean, clean_tokens
from ..operators import classify as C
from ..operators import grouped, lexical, rank, vectors
from ..operators.parts import Model, Parts
from ..session import shared_path, shuffled
from ..sources import sinks
from ..sources.views import view
from . import oracle as O
from .registry import register

CFG = C.ClassifyConfig()
LEAN = C.ClassifyConfig(use_hierarchy=False, use_features=False)
_CTES = O.classify_ctes()
_LEAN_CTES = O.classify_ctes(use_hierarchy=False, use_features=False)
VIEWS = ("catalog", "products")


def r6(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


def _inputs(spark, sf):
    return view(spark, sf, "products"), view(spark, sf, "catalog")


def _fused(spark, sf, cfg=CFG):
    products, catalog = _inputs(spark, sf)
    return C.retrieve(products, catalog, cfg), products


def _scored(spark, sf, cfg=CFG):
    cands, products = _fused(spark, sf, cfg)
    return C.score_candidates(cands, products, cfg)


def _pred_out(preds):
    return preds.select("product_id", "rank", "commodity_code", "commodity_name", r6("score").alias("score"),
                        "segment", "family", "class", "in_hierarchy")


# ---------------------------------------------------------------- C1-C5

@register("c_classify_batch", views=VIEWS, sql=f"WITH {_CTES}\nSELECT {O.PRED_COLS} FROM preds WHERE rank <= 10")
def c_classify_batch(spark, sf):
    products, catalog = _inputs(spark, sf)
    return _pred_out(C.classify_batch(products, catalog, CFG))


@register("c_classify_lean", views=VIEWS, sql=f"WITH {_LEAN_CTES}\nSELECT {O.PRED_COLS} FROM preds WHERE rank <= 10")
def c_classify_lean(spark, sf):
    products, catalog = _inputs(spark, sf)
    return _pred_out(C.classify_lean(products, catalog, CFG))


_ONE_TEXT = "WHILE SUPPLIES LAST: BRAND#13 RED WIDGET S12 12 GAL 115V SS PROMO"
_ONE_SQL = f"SELECT CAST(0 AS BIGINT) AS product_id, {O.q(_ONE_TEXT)} AS description"


@register("c_one", views=("catalog",), sql=f"WITH one AS ({_ONE_SQL}),\n{O.classify_ctes(products='one')}\n"
                                           f"SELECT {O.PRED_COLS} FROM preds WHERE rank <= 10")
def c_one(spark, sf):
    """One description through the same plan, against the whole catalog."""
    one = spark.sql(_ONE_SQL)
    return _pred_out(C.classify_batch(one, view(spark, sf, "catalog"), CFG))


@register("c_sample", views=VIEWS, sql=f"""WITH {_CTES},
firstp AS (SELECT product_id FROM products ORDER BY product_id LIMIT 5)
SELECT {O.PRED_COLS} FROM preds WHERE rank <= 3 AND query_id IN (SELECT product_id FROM firstp)""")
def c_sample(spark, sf):
    """The first 5 products (by id) with their top 3 predictions."""
    products, catalog = _inputs(spark, sf)
    first = products.select("product_id").orderBy("product_id").limit(5)
    preds = C.classify_batch(products.join(first, "product_id", "left_semi"), catalog, CFG)
    return _pred_out(preds.filter(F.col("rank") <= 3))


@register("c_nested", views=VIEWS, sql=f"""WITH {_CTES}
SELECT p.product_id, p.description, p.commodity_name AS ground_truth, {", ".join("r." + c for c in (
    "rank", "commodity_code", "commodity_name", "score", "segment", "family", "class", "in_hierarchy"))}
FROM products p LEFT JOIN (SELECT {O.PRED_COLS} FROM preds WHERE rank <= 10) r ON r.product_id = p.product_id""")
def c_nested(spark, sf):
    """C3 nested: one row per product, predictions as array<struct> sorted by rank; flattened again to compare."""
    products, catalog = _inputs(spark, sf)
    nested = C.nest(C.classify_batch(products, catalog, CFG), products)
    flat = nested.select("product_id", "description", "ground_truth", F.explode_outer("top_k_predictions").alias("p"))
    return flat.select("product_id", "description", "ground_truth", "p.*").withColumn("score", r6("score"))


@register("c_prebuilt", views=VIEWS, sql=f"WITH {_CTES}\nSELECT {O.PRED_COLS} FROM preds WHERE rank <= 10")
def c_prebuilt(spark, sf):
    """C2 from tables that were written once: index, clustered vectors and enriched catalog."""
    products, catalog = _inputs(spark, sf)
    tables = C.prebuild(catalog, shared_path(spark, "classifier"), CFG)
    return _pred_out(C.classify_batch(products, catalog, CFG, **tables))


# ---------------------------------------------------------------- R10, R11, R13

@register("r_hybrid_fuse", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("sem_score")} AS sem_score, {O.round6("lex_score")} AS lex_score,
       CAST(cand_pos AS INTEGER) AS cand_pos FROM fused""")
def r_hybrid_fuse(spark, sf):
    cands, _ = _fused(spark, sf)
    return cands.select("query_id", "doc_id", r6("sem_score").alias("sem_score"), r6("lex_score").alias("lex_score"),
                        F.col("cand_pos").cast("int").alias("cand_pos"))


@register("r_candidate_counts", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, count(*) AS n_candidates FROM fused GROUP BY query_id""")
def r_candidate_counts(spark, sf):
    cands, _ = _fused(spark, sf)
    return rank.candidate_counts(cands)


# ---------------------------------------------------------------- X1-X4

@register("x_pair_rerank", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("cross_score")} AS cross_score, CAST(rerank_pos AS INTEGER) AS rerank_pos FROM rr""")
def x_pair_rerank(spark, sf):
    x = _scored(spark, sf, LEAN)
    return x.select("query_id", "doc_id", r6("cross_score").alias("cross_score"),
                    F.col("rerank_pos").cast("int").alias("rerank_pos"))


@register("x_minmax", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("hybrid_norm")} AS hybrid_norm, {O.round6("cross_norm")} AS cross_norm FROM merged""")
def x_minmax(spark, sf):
    x = _scored(spark, sf, LEAN)
    return x.select("query_id", "doc_id", r6("hybrid_norm").alias("hybrid_norm"), r6("cross_norm").alias("cross_norm"))


@register("x_merge", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("final_score")} AS final_score FROM merged2""")
def x_merge(spark, sf):
    x = _scored(spark, sf, LEAN)
    return x.select("query_id", "doc_id", r6("final_score").alias("final_score"))


@register("x_topn", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(final_score, 9) DESC, round(cross_score, 9) DESC,
                               cand_pos) AS rk FROM merged2) WHERE rk <= 5""")
def x_topn(spark, sf):
    x = _scored(spark, sf, LEAN)
    order = [F.round("final_score", 9).desc(), F.round("cross_score", 9).desc(), F.col("cand_pos").asc()]
    return rank.top_n(x, 5, order, rank_col="rk").select("query_id", "doc_id", F.col("rk").cast("int").alias("rank"))


# ---------------------------------------------------------------- H8, H9, F6, F7

@register("h_boost", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, in_hierarchy, {O.round6("boosted_score")} AS boosted_score FROM boosted""")
def h_boost(spark, sf):
    x = _scored(spark, sf, C.ClassifyConfig(use_features=False))
    return x.select("query_id", "doc_id", "in_hierarchy", r6("boosted_score").alias("boosted_score"))


@register("h_flag_only", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, in_hierarchy,
       {O.round6("CASE WHEN in_hierarchy THEN CAST(1.3 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END")} AS hierarchy_boost FROM boosted""")
def h_flag_only(spark, sf):
    from ..operators import hierarchy

    cands, products = _fused(spark, sf)
    x = hierarchy.evidence_segments(cands, CFG.route_top)
    x = x.join(shuffled(products.select(F.col("product_id").alias("query_id"), "description")), "query_id")
    x = x.withColumn("cross_score", rank.token_cosine(
        F.array_distinct(C.clean_token_list("description")), F.col("doc_tokens")))
    x = hierarchy.boost(rank.rerank(x, CFG.rerank_k), CFG.boost, multiply=False)
    return x.select("query_id", "doc_id", "in_hierarchy", r6("hierarchy_boost").alias("hierarchy_boost"))


@register("f_similarity", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("feature_sim")} AS feature_sim FROM scored""")
def f_similarity(spark, sf):
    x = _scored(spark, sf)
    return x.select("query_id", "doc_id", r6("feature_sim").alias("feature_sim"))


@register("f_blend", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("final_boosted_score")} AS final_boosted_score FROM scored2""")
def f_blend(spark, sf):
    x = _scored(spark, sf)
    return x.select("query_id", "doc_id", r6("final_boosted_score").alias("final_boosted_score"))


# ---------------------------------------------------------------- C2 with replaced parts; R7, R11

def _letter_counts():
    """A stand-in for a text model: shares of four letters, so that SQL can compute the same vectors."""
    import numpy as np

    return lambda texts: np.array([[t.count(c) / (1.0 + len(t)) for c in "aeio"] for t in texts]).reshape(len(texts), 4)


def _length_ratio():
    """A stand-in for a pair model: the shorter text's length by the longer one's."""
    return lambda qs, ds: [min(len(q), len(d)) / (1.0 + max(len(q), len(d))) for q, d in zip(qs, ds)]


def _letters(c):
    return F.array(*[(F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))).cast("double") for x in "rst"])


CUSTOM = Parts(cleaner=clean_tokens, embedder=Model("letter-counts", _letter_counts), dim=4, pair_model=Model("length-ratio", _length_ratio), extractor=_letters)
_LETTER_SQL = lambda x: f"list_transform(['a', 'e', 'i', 'o'], lambda l: (length({x}) - length(replace({x}, l, ''))) / (1.0 + length({x})))"
_CUSTOM = O.classify_ctes(
    tok=lambda x: O.tokens(O.token_map(x)), clean=O.token_map, embed=_LETTER_SQL,
    cross=lambda a, b: f"least(length({a}), length({b})) / (1.0 + greatest(length({a}), length({b})))",
    features=lambda x: "[" + ", ".join(f"length({x}) - length(replace({x}, '{l}', ''))" for l in "rst") + "]::DOUBLE[]", n_features=3)


@register("c_custom_parts", views=VIEWS, sql=f"WITH {_CUSTOM}\nSELECT {O.PRED_COLS} FROM preds WHERE rank <= 10")
def c_custom_parts(spark, sf):
    """C2 with another cleaner, embedder, pair model and extractor, from tables prebuilt with the same parts."""
    products, catalog = _inputs(spark, sf)
    tables = C.prebuild(catalog, shared_path(spark, "classifier-custom"), CFG, CUSTOM)
    return _pred_out(C.classify_batch(products, catalog, CFG, parts=CUSTOM, **tables))


_SEM_ONLY = f"WITH {_CTES}, hit AS (SELECT s.query_id, s.doc_id, s.sem_score, s.sem_rank, cat.* EXCLUDE (corpus), corpus FROM sem s JOIN cat ON cat.commodity_code = s.doc_id WHERE sem_rank <= 10)"


@register("r_search_text", views=VIEWS, sql=f"""{_SEM_ONLY}
SELECT query_id, CAST(sem_rank AS INTEGER) AS rank, corpus, commodity_code, commodity_name, segment_name, family_name, class_name FROM hit""")
def r_search_text(spark, sf):
    """Description texts in, the documents (text and metadata) of the ten nearest catalog rows out."""
    products, catalog = _inputs(spark, sf)
    docs = C.with_corpus(catalog).repartition("commodity_code")  # one unsplit file is still embedded by many tasks
    table = sinks.build_vector_table(docs, shared_path(spark, "searched"))
    found = vectors.search_text(products, 10, vectors.cluster(table), lambda c: hash_embed(clean(c), CFG.embed_dim), "product_id", "description")
    out = found.join(shuffled(table.select("doc_id", "corpus", "metadata")), "doc_id")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "corpus", F.col("doc_id").alias("commodity_code"), "metadata.commodity_name",
                      "metadata.segment_name", "metadata.family_name", "metadata.class_name")


_UNIFORM = ["commodity_code", "commodity_name", "segment_name"]


@register("r_uniform_scored", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, CAST(cand_pos AS INTEGER) AS cand_pos, commodity_code, commodity_name, segment_name,
       {O.round6("sem_score")} AS sem_score, {O.round6("lex_score")} AS lex_score FROM fused""")
def r_uniform_scored(spark, sf):
    """R11 with scores: the fused candidates as uniform rows."""
    cands, _ = _fused(spark, sf)
    out = rank.uniform_rows(cands, _UNIFORM)
    return out.select("query_id", "doc_id", F.col("cand_pos").cast("int").alias("cand_pos"), *_UNIFORM, r6("sem_score").alias("sem_score"), r6("lex_score").alias("lex_score"))


@register("r_uniform_plain", views=VIEWS, sql=f"""{_SEM_ONLY}
SELECT query_id, doc_id, CAST(sem_rank AS INTEGER) AS cand_pos, commodity_code, commodity_name, segment_name, CAST(0 AS DOUBLE) AS sem_score, CAST(0 AS DOUBLE) AS lex_score FROM hit""")
def r_uniform_plain(spark, sf):
    """R11 without scores: the hits of one retriever as the same rows, both scores 0."""
    products, catalog = _inputs(spark, sf)
    docs = C.with_corpus(catalog)
    index = vectors.cluster(Parts(dim=CFG.embed_dim).catalog(docs, "commodity_code", "corpus"))
    found = vectors.search_text(products, 10, index, lambda c: hash_embed(clean(c), CFG.embed_dim), "product_id", "description")
    hits = found.withColumnRenamed("rank", "cand_pos").join(shuffled(docs.withColumnRenamed("commodity_code", "doc_id").withColumn("commodity_code", F.col("doc_id"))), "doc_id")
    return rank.uniform_rows(hits, _UNIFORM, scores=False).withColumn("cand_pos", F.col("cand_pos").cast("int"))


# ---------------------------------------------------------------- R2, R3 by group bounds

@register("r_bm25_grouped", views=VIEWS, sql=f"""WITH {_CTES}
SELECT query_id, doc_id, {O.round6("lex_score")} AS score, CAST(lex_rank AS INTEGER) AS rank FROM lex""")
def r_bm25_grouped(spark, sf):
    """The fifty best catalog rows of every description, hardly any of whose words is selective."""
    products, catalog = _inputs(spark, sf)
    index = grouped.group_index(lexical.build_stored_index(C.with_corpus(catalog), "commodity_code", "corpus"))
    top = grouped.bm25_topk_grouped(products, "product_id", "description", index, CFG.retrieve_k)
    return top.select("query_id", "doc_id", r6("score").alias("score"), F.col("rank").cast("int").alias("rank"))
