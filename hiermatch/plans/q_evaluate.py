"""Registered evaluation queries (E1-E18, P10) and routing queries (H3-H7).

Most evaluation queries score the lexical classifier (BM25 top-10 of each
product over the catalog), which is cheap and exercises every metric path;
``e_metrics_classify`` scores the full classifier.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.embed import DIM
from ..operators import classify as C
from ..operators import evaluate as E
from ..operators import hierarchy as H
from ..operators import lexical, vectors
from ..operators.parts import Parts
from ..sources.views import view
from . import oracle as O
from .registry import register

VIEWS = ("catalog", "products_gate")
KS = E.KS


def r6(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


def _cat(spark, sf):
    return C.with_corpus(view(spark, sf, "catalog"))


def lex_preds(spark, sf, k=10):
    cat = _cat(spark, sf)
    idx = lexical.build_forward_index(cat, "commodity_code", "corpus")
    t = lexical.bm25_topk_dense(view(spark, sf, "products_gate"), "product_id", "description", idx, k)
    return t.select(F.col("query_id").alias("product_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("doc_id").alias("commodity_code"), "score")


_LEX_PREDS_SQL = f"""
cat AS (SELECT *, {O.corpus()} AS corpus FROM catalog),
{O.bm25_ctes("cat", "commodity_code", "corpus", "products_gate", "product_id", "description", prefix="l_").strip()},
preds AS (SELECT query_id AS product_id, CAST(rk AS INTEGER) AS rank, doc_id AS commodity_code, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rk FROM l_scores)
  WHERE rk <= 10)"""


def gate_sql(products: str = "products_gate") -> str:
    nk = O.name_key_ascii("coalesce(p.commodity_name, '')")
    return f"""
n2c AS (SELECT {O.name_key_ascii("commodity_name")} AS nk, min(commodity_code) AS true_code FROM catalog
        GROUP BY {O.name_key_ascii("commodity_name")}),
ch AS (SELECT commodity_code, arg_max(segment_name, commodity_code) AS segment_name,
              arg_max(family_name, commodity_code) AS family_name, arg_max(class_name, commodity_code) AS class_name,
              arg_max(commodity_name, commodity_code) AS commodity_name FROM catalog GROUP BY commodity_code),
g0 AS (SELECT p.product_id, p.description, p.commodity_name AS truth_name, {nk} AS nk, n2c.true_code
       FROM {products} p LEFT JOIN n2c ON n2c.nk = {nk}),
gate AS (SELECT g0.product_id, g0.description, g0.truth_name,
                CASE WHEN g0.description IS NULL OR g0.description = '' OR g0.nk = '' OR g0.true_code IS NULL
                          OR g0.true_code = 0 THEN 'skipped' ELSE 'evaluated' END AS status,
                CASE WHEN NOT (g0.description IS NULL OR g0.description = '' OR g0.nk = '' OR g0.true_code IS NULL
                          OR g0.true_code = 0) THEN g0.true_code END AS true_code, ch.segment_name AS true_segment, ch.family_name AS true_family,
                ch.class_name AS true_class, ch.commodity_name AS true_name
         FROM g0 LEFT JOIN ch ON ch.commodity_code = g0.true_code)"""


def per_product_sql(conf: str = "1.0", thr: float = E.THRESHOLD, match_names: bool = False) -> str:
    hit = "commodity_code = true_code"
    if match_names:
        hit = f"({hit} OR {O.join_key('pred_name')} = {O.join_key('truth_name')})"
    lvl = ",\n".join(
        f"max(CASE WHEN rank <= {k} AND {col} = true_{lv} THEN 1 ELSE 0 END) AS {lv}_hit_{k}"
        for k in KS for lv, col in E.LEVELS)
    per_k = ",\n".join(
        f"CASE WHEN hit_rank <= {k} THEN 1 ELSE 0 END AS hit_{k}, "
        f"CASE WHEN hit_rank <= {k} THEN 1 ELSE 0 END / CAST({k} AS DOUBLE) AS precision_{k}, "
        f"CASE WHEN n_dedup > 0 THEN CASE WHEN hit_rank <= {k} THEN 1 ELSE 0 END / CAST(least({k}, n_dedup) AS DOUBLE) "
        f"ELSE 0.0 END AS precision_kept_{k}, "
        f"CASE WHEN hit_rank <= {k} THEN 1.0 / log2(hit_rank + 1.0) ELSE 0.0 END AS ndcg_{k}, "
        f"CASE WHEN n_kept > 0 AND n_dedup < {k} THEN 1 ELSE 0 END AS insufficient_{k}, "
        + ", ".join(f"coalesce({lv}_hit_{k}, 0) AS {lv}_hit_{k}" for lv, _ in E.LEVELS)
        for k in KS)
    return f"""
evl AS (SELECT * FROM gate WHERE status = 'evaluated'),
pr AS (SELECT * FROM preds WHERE product_id IN (SELECT product_id FROM evl)),
raw_n AS (SELECT product_id, count(*) AS n_raw FROM pr GROUP BY product_id),
kept AS (SELECT * FROM pr WHERE coalesce({conf}, 1.0) >= {thr}),
kept_n AS (SELECT product_id, count(*) AS n_kept FROM kept GROUP BY product_id),
dd0 AS (SELECT product_id, commodity_code, min(rank) AS orig_rank FROM kept
        WHERE commodity_code IS NOT NULL AND commodity_code <> 0 GROUP BY product_id, commodity_code),
dd AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY orig_rank, commodity_code) AS rank FROM dd0),
ddj AS (SELECT dd.*, ch.segment_name, ch.family_name, ch.class_name, ch.commodity_name AS pred_name,
               evl.true_code, evl.true_segment, evl.true_family, evl.true_class, evl.truth_name
        FROM dd LEFT JOIN ch ON ch.commodity_code = dd.commodity_code JOIN evl ON evl.product_id = dd.product_id),
agg AS (SELECT product_id, count(*) AS n_dedup, min(CASE WHEN {hit} THEN rank END) AS hit_rank,
        {lvl} FROM ddj GROUP BY product_id),
pp0 AS (SELECT evl.product_id, coalesce(raw_n.n_raw, 0) AS n_raw, coalesce(kept_n.n_kept, 0) AS n_kept,
               coalesce(agg.n_dedup, 0) AS n_dedup, agg.hit_rank, {", ".join(f"agg.{lv}_hit_{k}" for k in KS for lv, _ in E.LEVELS)}
        FROM evl LEFT JOIN raw_n ON raw_n.product_id = evl.product_id LEFT JOIN kept_n ON kept_n.product_id = evl.product_id
        LEFT JOIN agg ON agg.product_id = evl.product_id),
pp AS (SELECT product_id, n_raw, n_kept, n_dedup, hit_rank,
              CASE WHEN n_raw = 0 THEN 1 ELSE 0 END AS no_pred,
              CASE WHEN n_raw > 0 AND n_kept = 0 THEN 1 ELSE 0 END AS all_filtered,
              coalesce(1.0 / hit_rank, 0.0) AS rr,
              {per_k}
       FROM pp0)"""


def metrics_sql(thr: float = E.THRESHOLD) -> str:
    per_k = ",\n".join(
        f"{O.round6(f'coalesce(avg(hit_{k}) * 100.0, 0.0)')} AS accuracy_at_{k}, "
        f"{O.round6(f'coalesce(avg(precision_{k}) * 100.0, 0.0)')} AS precision_at_{k}, "
        f"{O.round6(f'coalesce(avg(ndcg_{k}) * 100.0, 0.0)')} AS ndcg_at_{k}, "
        f"{O.round6(f'coalesce(avg(hit_{k}) * 100.0, 0.0)')} AS recall_at_{k}, "
        + ", ".join(f"{O.round6(f'coalesce(avg({lv}_hit_{k}) * 100.0, 0.0)')} AS {lv}_match_at_{k}" for lv, _ in E.LEVELS)
        + f", CAST(coalesce(sum(insufficient_{k}), 0) AS BIGINT) AS insufficient_at_{k}"
        for k in KS)
    return f"""
counts AS (SELECT CAST(coalesce(sum(CASE WHEN status = 'evaluated' THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_evaluated,
                  CAST(coalesce(sum(CASE WHEN status = 'skipped' THEN 1 ELSE 0 END), 0) AS BIGINT) AS skipped FROM gate),
m AS (SELECT CAST(coalesce(sum(no_pred), 0) AS BIGINT) AS no_predictions,
             CAST(coalesce(sum(all_filtered), 0) AS BIGINT) AS all_filtered,
             CAST(coalesce(sum(n_raw - n_kept), 0) AS BIGINT) AS predictions_filtered,
             {O.round6("coalesce(avg(rr), 0.0)")} AS mrr,
             {per_k}
      FROM pp),
mrow AS (SELECT counts.*, m.no_predictions, m.all_filtered, m.predictions_filtered,
                CAST({thr} AS DOUBLE) AS confidence_threshold, m.* EXCLUDE (no_predictions, all_filtered,
                predictions_filtered) FROM counts, m)"""


def _round_metrics(df):
    return df.select(*[r6(c).alias(c) if t == "double" and c != "confidence_threshold" else F.col(c)
                       for c, t in df.dtypes])


def _pp(spark, sf, preds, conf_col=None, thr=E.THRESHOLD, match_names=False):
    cat = view(spark, sf, "catalog")
    g = E.gate(view(spark, sf, "products_gate"), cat)
    return E.per_product(g, preds, cat, KS, thr, conf_col, match_names=match_names)


_PP = "WITH " + _LEX_PREDS_SQL.strip() + "," + gate_sql().rstrip() + "," + per_product_sql().rstrip()


def _pp_query(name, names, rounded=()):
    cols_sql = ", ".join(f"{O.round6(n)} AS {n}" if n in rounded else n for n in names)

    @register(name, views=VIEWS, sql=_PP + f"\nSELECT {cols_sql} FROM pp")
    def q(spark, sf):
        pp = _pp(spark, sf, lex_preds(spark, sf))
        return pp.select(*[r6(n).alias(n) if n in rounded else F.col(n) for n in names])

    q.__name__ = name
    return q


# ---------------------------------------------------------------- E2-E10 per product

@register("e_gate", views=VIEWS, sql="WITH " + gate_sql().strip() + "\nSELECT product_id, status, true_code FROM gate")
def e_gate(spark, sf):
    g = E.gate(view(spark, sf, "products_gate"), view(spark, sf, "catalog"))
    return g.select("product_id", "status", "true_code")


_THR = 12.0
_PP_THR = "WITH " + _LEX_PREDS_SQL.strip() + "," + gate_sql().rstrip() + "," + per_product_sql("score", _THR).rstrip()


@register("e_threshold", views=VIEWS, sql=_PP_THR + "\nSELECT product_id, n_raw, n_kept, no_pred, all_filtered FROM pp")
def e_threshold(spark, sf):
    pp = _pp(spark, sf, lex_preds(spark, sf), conf_col="score", thr=_THR)
    return pp.select("product_id", "n_raw", "n_kept", "no_pred", "all_filtered")


def dup_preds(spark, sf):
    """A ranked list with repeated codes: lexical top 5 followed by semantic top 5."""
    cat = _cat(spark, sf)
    lx = lex_preds(spark, sf, 5).select("product_id", "rank", "commodity_code")
    p = view(spark, sf, "products_gate")
    parts = Parts(dim=DIM)
    sm = vectors.knn(parts.queries(p, "product_id", "description"), parts.catalog(cat, "commodity_code", "corpus"), 5).select(F.col("query_id").alias("product_id"),
                                       (F.col("rank") + 5).cast("int").alias("rank"),
                                       F.col("doc_id").alias("commodity_code"))
    return lx.unionByName(sm)


_DUP_SQL = f"""WITH {_LEX_PREDS_SQL.strip()},
qv0 AS (SELECT product_id AS query_id, {O.hash_embed(O.clean("description"), DIM)} AS c FROM products_gate),
qv AS (SELECT query_id, {O.l2norm_sql("c")} AS v FROM qv0),
cv0 AS (SELECT commodity_code AS doc_id, {O.hash_embed("corpus", DIM)} AS c FROM cat),
cv AS (SELECT doc_id, {O.l2norm_sql("c")} AS v FROM cv0),
dist AS (SELECT qv.query_id, cv.doc_id, {O.sqdist("qv.v", "cv.v")} AS d FROM qv, cv),
sem AS (SELECT query_id AS product_id, CAST(rk + 5 AS INTEGER) AS rank, doc_id AS commodity_code FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), doc_id) AS rk FROM dist) WHERE rk <= 5),
dupp AS (SELECT product_id, rank, commodity_code FROM preds WHERE rank <= 5 UNION ALL SELECT * FROM sem),
dd0 AS (SELECT product_id, commodity_code, min(rank) AS orig_rank FROM dupp
        WHERE commodity_code IS NOT NULL AND commodity_code <> 0 GROUP BY product_id, commodity_code)
SELECT product_id, commodity_code, orig_rank,
       CAST(row_number() OVER (PARTITION BY product_id ORDER BY orig_rank, commodity_code) AS INTEGER) AS rank FROM dd0"""


@register("e_dedupe", views=VIEWS, sql=_DUP_SQL)
def e_dedupe(spark, sf):
    d = E.dedupe(dup_preds(spark, sf))
    return d.select("product_id", "commodity_code", "orig_rank", F.col("rank").cast("int").alias("rank"))


_PREC = [f"precision_{k}" for k in KS]
_PREC_KEPT = [f"precision_kept_{k}" for k in KS]
_NDCG = [f"ndcg_{k}" for k in KS]
_pp_query("e_mrr", ["product_id", "hit_rank", "rr"], {"rr"})
_pp_query("e_accuracy", ["product_id", "hit_1", "hit_5", "hit_10"])
_pp_query("e_precision", ["product_id"] + _PREC, set(_PREC))
_pp_query("e_precision_kept", ["product_id"] + _PREC_KEPT, set(_PREC_KEPT))
_pp_query("e_ndcg", ["product_id"] + _NDCG, set(_NDCG))
_pp_query("e_hierarchy_match", ["product_id"] + [f"{lv}_hit_{k}" for k in KS for lv, _ in E.LEVELS])
_pp_query("e_insufficient", ["product_id"] + [f"insufficient_{k}" for k in KS])


@register("e_recall", views=VIEWS, sql=_PP + "\nSELECT " + ", ".join(
    f"{O.round6(f'coalesce(avg(hit_{k}), 0.0)')} AS recall_at_{k}" for k in KS) + " FROM pp")
def e_recall(spark, sf):
    pp = _pp(spark, sf, lex_preds(spark, sf))
    return pp.agg(*[r6(F.coalesce(F.avg(f"hit_{k}"), F.lit(0.0))).alias(f"recall_at_{k}") for k in KS])


_PP_NAMES = "WITH " + _LEX_PREDS_SQL.strip() + "," + gate_sql().rstrip() + "," + per_product_sql(match_names=True).rstrip()


@register("e_code_or_name", views=VIEWS, sql=_PP_NAMES + "\nSELECT product_id, hit_rank FROM pp")
def e_code_or_name(spark, sf):
    return _pp(spark, sf, lex_preds(spark, sf), match_names=True).select("product_id", "hit_rank")


# ---------------------------------------------------------------- E11, E18, P10

_METRICS = _PP + "," + metrics_sql().rstrip()


@register("e_metrics_row", views=VIEWS, sql=_METRICS + "\nSELECT * FROM mrow")
def e_metrics_row(spark, sf):
    m = E.metrics_row(view(spark, sf, "products_gate"), lex_preds(spark, sf), view(spark, sf, "catalog"))
    return _round_metrics(m)


@register("e_metrics_long", views=VIEWS, sql=_METRICS + "\n" + "\nUNION ALL ".join(
    f"SELECT {i + 1} AS ord, '{n}' AS metric, {O.round6(f'CAST({n} AS DOUBLE)')} AS value FROM mrow"
    for i, n in enumerate(E.display_order())))
def e_metrics_long(spark, sf):
    """Metrics in display order as (ord, metric, value)."""
    return E.metrics_long(e_metrics_row(spark, sf)).withColumn("value", r6("value"))


@register("e_invariants", views=VIEWS, sql=_METRICS + """
SELECT segment_match_at_1 >= accuracy_at_1 AS segment_ge_accuracy,
       class_match_at_5 <= family_match_at_5 AND family_match_at_5 <= segment_match_at_5 AS levels_nested,
       accuracy_at_1 <= accuracy_at_5 AND accuracy_at_5 <= accuracy_at_10 AS accuracy_monotone,
       abs(precision_at_5 - accuracy_at_5 / 5) < 1e-4 AS precision_is_accuracy_over_k,
       abs(ndcg_at_1 - accuracy_at_1) < 1e-4 AS ndcg1_is_accuracy1
FROM mrow""")
def e_invariants(spark, sf):
    """P10 and the SURVEY §5 invariants as boolean columns of the metrics row."""
    return E.invariants(e_metrics_row(spark, sf))


# ---------------------------------------------------------------- E17 error analysis

def errors_long(spark, sf):
    return E.error_analysis(view(spark, sf, "products_gate"), lex_preds(spark, sf), view(spark, sf, "catalog"))


def errors_sql(preds: str) -> str:
    """Rows of E17 for the predictions that the CTEs ``preds`` define."""
    return "WITH " + preds.strip() + "," + gate_sql().rstrip() + """,
evd AS (SELECT * FROM gate WHERE status = 'evaluated'),
p5 AS MATERIALIZED (SELECT * FROM preds WHERE rank <= 5),
miss AS (SELECT evd.* FROM evd WHERE product_id IN (SELECT product_id FROM p5)
         AND product_id NOT IN (SELECT p5.product_id FROM p5 JOIN evd e2 ON e2.product_id = p5.product_id
                                WHERE p5.commodity_code = e2.true_code)),
firstm AS (SELECT * FROM miss ORDER BY product_id LIMIT 20)
SELECT f.product_id, f.description, f.true_code, f.true_name, f.true_class, f.true_family, p5.rank,
       p5.commodity_code AS code, coalesce(ch.commodity_name, 'Unknown') AS name, CAST(0.0 AS DOUBLE) AS confidence,
       coalesce(ch.class_name, 'Unknown') AS class
FROM firstm f JOIN p5 ON p5.product_id = f.product_id LEFT JOIN ch ON ch.commodity_code = p5.commodity_code"""


@register("e_errors", views=VIEWS, sql=errors_sql(_LEX_PREDS_SQL))
def e_errors(spark, sf):
    """E17 long form: one row per (error product, prediction)."""
    return errors_long(spark, sf)


@register("e_errors_nested", views=VIEWS, sql=errors_sql(_LEX_PREDS_SQL))
def e_errors_nested(spark, sf):
    """E17 nested form, flattened again for the comparison."""
    nested = E.nest_errors(errors_long(spark, sf))
    flat = nested.select(*[c for c in nested.columns if c != "predictions"], F.posexplode("predictions").alias("rank", "p"))
    return flat.select(*[c for c in nested.columns if c != "predictions"], (F.col("rank") + 1).alias("rank"), "p.*")


# ---------------------------------------------------------------- E14, E15 over the query table

def _query_lex(spark, sf):
    cat = _cat(spark, sf)
    idx = lexical.build_forward_index(cat, "commodity_code", "corpus")
    t = lexical.bm25_topk_dense(view(spark, sf, "search_queries"), "query_id", "search_query", idx, 10)
    return t.join(cat.select(F.col("commodity_code").alias("doc_id"), F.col("commodity_name").alias("pred_name"),
                             "segment_name", "family_name", "class_name"), "doc_id")


_QLEX = f"""WITH cat AS (SELECT *, {O.corpus()} AS corpus FROM catalog),
{O.bm25_ctes("cat", "commodity_code", "corpus", "search_queries", "query_id", "search_query", prefix="s_").strip()},
top AS (SELECT t.query_id, t.doc_id, t.rk, c.commodity_name AS pred_name, c.segment_name, c.family_name, c.class_name FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rk FROM s_scores) t
  JOIN cat c ON c.commodity_code = t.doc_id WHERE t.rk <= 10)"""


@register("e_text_label", views=("catalog", "search_queries"), sql=_QLEX + f""",
h AS (SELECT s.query_id, min(CASE WHEN {O.join_key("top.pred_name")} = {O.join_key("s.commodity_name")} THEN top.rk END) AS hr
      FROM search_queries s LEFT JOIN top ON top.query_id = s.query_id GROUP BY s.query_id)
SELECT {O.round6("avg(CASE WHEN hr <= 1 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_1,
       {O.round6("avg(CASE WHEN hr <= 5 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_5,
       {O.round6("avg(CASE WHEN hr <= 10 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_10,
       {O.round6("avg(CASE WHEN hr <= 5 THEN 1.0 ELSE 0.0 END / 5)")} AS precision_at_5,
       {O.round6("avg(CASE WHEN hr <= 5 THEN 1.0 ELSE 0.0 END)")} AS recall_at_5 FROM h""")
def e_text_label(spark, sf):
    """Lean metrics over the query table, relevance = label text equals predicted name."""
    m = E.text_label_metrics(view(spark, sf, "search_queries"), _query_lex(spark, sf))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("e_level5", views=("catalog", "search_queries"), sql=_QLEX + f""",
tl AS (SELECT commodity_name, arg_max(segment_name, commodity_code) AS ts, arg_max(family_name, commodity_code) AS tf,
              arg_max(class_name, commodity_code) AS tc FROM catalog GROUP BY commodity_name),
h AS (SELECT s.query_id,
             coalesce(max(CASE WHEN top.rk <= 5 AND top.segment_name = tl.ts THEN 1 ELSE 0 END), 0) AS seg,
             coalesce(max(CASE WHEN top.rk <= 5 AND top.family_name = tl.tf THEN 1 ELSE 0 END), 0) AS fam,
             coalesce(max(CASE WHEN top.rk <= 5 AND top.class_name = tl.tc THEN 1 ELSE 0 END), 0) AS cls
      FROM search_queries s LEFT JOIN tl ON tl.commodity_name = s.commodity_name
      LEFT JOIN top ON top.query_id = s.query_id GROUP BY s.query_id)
SELECT {O.round6("avg(seg)")} AS segment_at_5, {O.round6("avg(fam)")} AS family_at_5,
       {O.round6("avg(cls)")} AS class_at_5 FROM h""")
def e_level5(spark, sf):
    """Hierarchy accuracy @5, truth levels looked up in the catalog by the label name."""
    truth = H.reverse_lookup(view(spark, sf, "catalog"))
    m = E.level_accuracy(view(spark, sf, "search_queries"), _query_lex(spark, sf), truth)
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("e_graded_ndcg", views=("catalog", "search_queries"), sql=_QLEX + f""",
gr AS (SELECT s.query_id, c.commodity_code AS doc_id, CASE WHEN c.commodity_name = s.commodity_name THEN 3 ELSE 1 END AS grade
       FROM search_queries s JOIN catalog t ON t.commodity_name = s.commodity_name
       JOIN catalog c ON c.class_name = t.class_name),
idl AS (SELECT query_id, sum(CASE WHEN r <= 5 THEN grade / log2(r + 1.0) ELSE 0.0 END) AS best FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc_id) AS r FROM gr) GROUP BY query_id),
got AS (SELECT gr.query_id, sum(CASE WHEN top.rk <= 5 THEN grade / log2(top.rk + 1.0) ELSE 0.0 END) AS dcg
        FROM gr JOIN top ON top.query_id = gr.query_id AND top.doc_id = gr.doc_id GROUP BY gr.query_id)
SELECT idl.query_id, {O.round6("coalesce(dcg, 0.0)")} AS dcg_5, {O.round6("coalesce(dcg, 0.0) / best")} AS ndcg_5
FROM idl LEFT JOIN got USING (query_id)""")
def e_graded_ndcg(spark, sf):
    """E8 graded: the true commodity gains 3, others of its class 1."""
    cat, q = view(spark, sf, "catalog"), view(spark, sf, "search_queries").select("query_id", "commodity_name")
    of = q.join(cat.select("commodity_name", "class_name"), "commodity_name")
    grades = of.join(cat.select("class_name", F.col("commodity_code").alias("doc_id"), F.col("commodity_name").alias("name")), "class_name")
    grades = grades.select("query_id", "doc_id", F.when(F.col("name") == F.col("commodity_name"), 3).otherwise(1).alias("grade"))
    m = E.graded_ndcg(_query_lex(spark, sf), grades, ks=(5,))
    return m.select("query_id", r6("dcg_5").alias("dcg_5"), r6("ndcg_5").alias("ndcg_5"))


# ---------------------------------------------------------------- full classifier metrics

_CLS = O.classify_ctes(products="products_gate")


@register("e_metrics_classify", views=VIEWS, sql="WITH " + _CLS.strip() + ",\n"
          "preds0 AS (SELECT query_id AS product_id, CAST(rank AS INTEGER) AS rank, commodity_code FROM preds "
          "WHERE rank <= 10)," + gate_sql().rstrip() + ","
          + per_product_sql().replace("FROM preds WHERE", "FROM preds0 WHERE").rstrip() + ","
          + metrics_sql().rstrip() + "\nSELECT * FROM mrow")
def e_metrics_classify(spark, sf):
    """E11 over the full classifier's predictions (the reference's evaluate())."""
    p = view(spark, sf, "products_gate")
    cat = view(spark, sf, "catalog")
    preds = C.classify_batch(p, cat)
    return _round_metrics(E.metrics_row(p, preds, cat))


@register("e_errors_classify", views=VIEWS, sql=errors_sql(_CLS.strip() + """,
preds0 AS (SELECT query_id AS product_id, CAST(rank AS INTEGER) AS rank, commodity_code FROM preds WHERE rank <= 10)""").replace(
    "SELECT * FROM preds WHERE rank <= 5", "SELECT * FROM preds0 WHERE rank <= 5"))
def e_errors_classify(spark, sf):
    """E17 over the full classifier's predictions."""
    p, cat = view(spark, sf, "products_gate"), view(spark, sf, "catalog")
    return E.error_analysis(p, C.classify_batch(p, cat), cat)


# ---------------------------------------------------------------- H3-H7 routing on fused candidates

def _fused(spark, sf):
    return C.retrieve(view(spark, sf, "products"), view(spark, sf, "catalog"))


_FUSED = O.classify_ctes(use_hierarchy=False, use_features=False)
_EV = f"""WITH {_FUSED.strip()},
ev0 AS (SELECT query_id, 'segment' AS level, segment_name AS name FROM fused WHERE cand_pos <= 5
        UNION ALL SELECT query_id, 'family', family_name FROM fused WHERE cand_pos <= 5
        UNION ALL SELECT query_id, 'class', class_name FROM fused WHERE cand_pos <= 5),
evc AS (SELECT query_id, level, name, count(*) AS cnt FROM ev0 WHERE name IS NOT NULL AND name <> ''
        GROUP BY query_id, level, name),
e_sf AS (SELECT DISTINCT segment_name AS p, family_name AS c FROM cat),
e_fc AS (SELECT DISTINCT family_name AS p, class_name AS c FROM cat),
e_cc AS (SELECT DISTINCT class_name AS p, commodity_name AS c FROM cat),
segs AS (SELECT query_id, name AS seg FROM evc WHERE level = 'segment')"""


@register("h_evidence", views=("catalog", "products"), sql=_EV + "\nSELECT query_id, level, name, cnt FROM evc")
def h_evidence(spark, sf):
    return H.evidence(_fused(spark, sf))


@register("h_top_segments", views=("catalog", "products"), sql=_EV + """
SELECT query_id, segment_name, cnt, CAST(rk AS INTEGER) AS rk FROM (
  SELECT query_id, name AS segment_name, cnt, row_number() OVER (PARTITION BY query_id ORDER BY cnt DESC, name) AS rk
  FROM evc WHERE level = 'segment') WHERE rk <= 3""")
def h_top_segments(spark, sf):
    t = H.top_segments(H.evidence(_fused(spark, sf)))
    return t.select("query_id", "segment_name", "cnt", F.col("rk").cast("int").alias("rk"))


@register("h_top_families", views=("catalog", "products"), sql=_EV + """,
vf AS (SELECT DISTINCT segs.query_id, e_sf.c AS fam FROM segs JOIN e_sf ON e_sf.p = segs.seg WHERE e_sf.c IS NOT NULL),
fc AS (SELECT vf.query_id, vf.fam, coalesce(evc.cnt, 0) AS cnt FROM vf
       LEFT JOIN evc ON evc.query_id = vf.query_id AND evc.level = 'family' AND evc.name = vf.fam)
SELECT query_id, fam AS family_name, cnt, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cnt DESC, fam) AS rk FROM fc) WHERE rk <= 5""")
def h_top_families(spark, sf):
    f = H.top_families(H.evidence(_fused(spark, sf)), view(spark, sf, "catalog"))
    return f.select("query_id", "family_name", "cnt", F.col("rk").cast("int").alias("rk"))


@register("h_top_classes", views=("catalog", "products"), sql=_EV + """,
vc AS (SELECT DISTINCT segs.query_id, e_fc.c AS cls FROM segs JOIN e_sf ON e_sf.p = segs.seg
       JOIN e_fc ON e_fc.p = e_sf.c WHERE e_fc.c IS NOT NULL),
cc AS (SELECT vc.query_id, vc.cls, coalesce(evc.cnt, 0) AS cnt FROM vc
       LEFT JOIN evc ON evc.query_id = vc.query_id AND evc.level = 'class' AND evc.name = vc.cls)
SELECT query_id, cls AS class_name, cnt, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cnt DESC, cls) AS rk FROM cc) WHERE rk <= 5""")
def h_top_classes(spark, sf):
    c = H.top_classes(H.evidence(_fused(spark, sf)), view(spark, sf, "catalog"))
    return c.select("query_id", "class_name", "cnt", F.col("rk").cast("int").alias("rk"))


@register("h_closure_size", views=("catalog", "products"), sql=_EV + """,
reach AS (SELECT DISTINCT e_sf.p AS segment_name, e_cc.c AS commodity_name
          FROM e_sf JOIN e_fc ON e_sf.c = e_fc.p JOIN e_cc ON e_fc.c = e_cc.p)
SELECT segs.query_id, CAST(count(DISTINCT reach.commodity_name) AS BIGINT) AS num_constrained
FROM segs LEFT JOIN reach ON reach.segment_name = segs.seg GROUP BY segs.query_id""")
def h_closure_size(spark, sf):
    return H.closure_size(H.evidence(_fused(spark, sf)), view(spark, sf, "catalog"))

