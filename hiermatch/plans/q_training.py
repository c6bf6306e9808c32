"""Registered training-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.embed import DIM
from ..operators import classify as C
from ..operators import training as G
from ..operators import vectors
from ..operators.parts import Parts
from ..session import shuffled
from ..sources.views import view
from . import oracle as O
from .registry import register

VIEWS = ("catalog", "search_queries")
SEED = G.SEED


def _cat(spark, sf):
    return C.with_corpus(view(spark, sf, "catalog"))


def _pool_sql(name: str, group: str) -> str:
    return f"""{name} AS (SELECT {group} AS grp, commodity_code, lower(commodity_name) AS name_key, corpus AS neg_corpus,
    row_number() OVER (PARTITION BY {group} ORDER BY md5('{SEED}|' || CAST(commodity_code AS VARCHAR)), commodity_code) - 1
      AS pos,
    count(*) OVER (PARTITION BY {group}) AS group_size
  FROM cat WHERE {group} IS NOT NULL)"""


_OFFSET = f"((('0x' || substr(md5('{SEED}|' || CAST(q.query_id AS VARCHAR)), 1, 8))::BIGINT) % p.group_size)"

_BASE = f"""WITH cat AS (SELECT *, {O.corpus()} AS corpus FROM catalog),
ntc AS (SELECT {O.join_key("commodity_name")} AS truth_key, arg_max(corpus, commodity_code) AS positive
        FROM cat GROUP BY {O.join_key("commodity_name")}),
frl AS (SELECT lower(commodity_name) AS truth_key, arg_min(segment_name, commodity_code) AS true_segment,
               arg_min(family_name, commodity_code) AS true_family FROM cat GROUP BY lower(commodity_name)),
qs AS (SELECT s.query_id, s.search_query AS query_text, {O.join_key("s.commodity_name")} AS truth_key, ntc.positive
       FROM search_queries s JOIN ntc ON ntc.truth_key = {O.join_key("s.commodity_name")}
       WHERE ntc.positive IS NOT NULL AND ntc.positive <> ''),
{_pool_sql("fam", "family_name")},
{_pool_sql("seg", "segment_name")},
{_pool_sql("allc", "'*'")}"""

_TRIPLES_SQL = _BASE + f""",
qq AS (SELECT qs.*, frl.true_segment, frl.true_family FROM qs JOIN frl ON frl.truth_key = qs.truth_key),
qf AS (SELECT qq.*, coalesce(fs.group_size, 0) - coalesce(fa.c, 0) AS fam_others FROM qq
       LEFT JOIN (SELECT DISTINCT grp, group_size FROM fam) fs ON fs.grp = qq.true_family
       LEFT JOIN (SELECT grp, name_key, count(*) AS c FROM fam GROUP BY grp, name_key) fa
         ON fa.grp = qq.true_family AND fa.name_key = qq.truth_key),
cand AS (
  SELECT q.query_id, q.query_text, q.positive, q.truth_key, p.neg_corpus, p.name_key,
         ((p.pos - {_OFFSET}) % p.group_size + p.group_size) % p.group_size AS j
  FROM qf q JOIN fam p ON p.grp = q.true_family
  WHERE q.fam_others >= 5 AND p.name_key IS DISTINCT FROM q.truth_key
  UNION ALL
  SELECT q.query_id, q.query_text, q.positive, q.truth_key, p.neg_corpus, p.name_key,
         ((p.pos - {_OFFSET}) % p.group_size + p.group_size) % p.group_size AS j
  FROM qf q JOIN seg p ON p.grp = q.true_segment
  WHERE q.fam_others < 5 AND p.name_key IS DISTINCT FROM q.truth_key),
picked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY j) AS pick FROM cand)
SELECT query_id, {O.clean("query_text")} AS query, positive, neg_corpus AS negative,
       truth_key AS positive_commodity, name_key AS negative_commodity, CAST(pick AS INTEGER) AS pick
FROM picked WHERE pick <= 5"""


@register("g_hard_triples", views=VIEWS, sql=_TRIPLES_SQL)
def g_hard_triples(spark, sf):
    t = G.hard_triples(view(spark, sf, "search_queries"), _cat(spark, sf))
    return t.withColumn("pick", F.col("pick").cast("int"))


_PAIRS_SQL = _BASE + f""",
cand AS (
  SELECT q.query_id, q.query_text, p.neg_corpus, p.name_key,
         ((p.pos - {_OFFSET}) % p.group_size + p.group_size) % p.group_size AS j
  FROM qs q JOIN allc p ON true WHERE p.name_key IS DISTINCT FROM q.truth_key),
picked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY j) AS pick FROM cand)
SELECT query_id, {O.clean("query_text")} AS query, positive AS document, 1 AS label, truth_key AS commodity,
       0 AS pick FROM qs
UNION ALL
SELECT query_id, {O.clean("query_text")}, neg_corpus, 0, name_key, CAST(pick AS INTEGER) FROM picked WHERE pick <= 5"""


@register("g_pairs", views=VIEWS, sql=_PAIRS_SQL)
def g_pairs(spark, sf):
    p = G.labelled_pairs(view(spark, sf, "search_queries"), _cat(spark, sf))
    return p.select("query_id", "query", "document", F.col("label").cast("int").alias("label"), "commodity",
                    F.col("pick").cast("int").alias("pick"))


@register("g_name_lookup", views=("catalog",), sql=f"""
WITH cat AS (SELECT *, {O.corpus()} AS corpus FROM catalog)
SELECT {O.join_key("commodity_name")} AS truth_key, arg_max(corpus, commodity_code) AS positive
FROM cat GROUP BY {O.join_key("commodity_name")}""")
def g_name_lookup(spark, sf):
    return G.name_to_corpus(_cat(spark, sf))


_MINED_SQL = f"""
WITH cat AS (SELECT *, {O.corpus()} AS corpus FROM catalog),
qv0 AS (SELECT query_id, {O.hash_embed(O.clean("search_query"), DIM)} AS c FROM search_queries),
qv AS (SELECT query_id, {O.l2norm_sql("c")} AS v FROM qv0),
cv0 AS (SELECT commodity_code AS doc_id, {O.hash_embed("corpus", DIM)} AS c FROM cat),
cv AS (SELECT doc_id, {O.l2norm_sql("c")} AS v FROM cv0),
dist AS (SELECT qv.query_id, cv.doc_id, {O.sqdist("qv.v", "cv.v")} AS d FROM qv, cv),
hits AS (SELECT query_id, doc_id, rk FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), doc_id) AS rk FROM dist) WHERE rk <= 50),
h AS (SELECT s.search_query AS query, s.commodity_name AS positive, c.corpus, hits.rk, hits.query_id
      FROM hits JOIN search_queries s ON s.query_id = hits.query_id JOIN cat c ON c.commodity_code = hits.doc_id
      WHERE {O.join_key("c.commodity_name")} IS DISTINCT FROM {O.join_key("s.commodity_name")}),
fs AS (SELECT query, positive, corpus, min(rk) AS rk FROM h GROUP BY query, positive, corpus),
top AS (SELECT *, row_number() OVER (PARTITION BY query, positive ORDER BY rk, corpus) AS k FROM fs)
SELECT query, positive, list(corpus ORDER BY k) AS negatives FROM top WHERE k <= 5 GROUP BY query, positive"""


@register("g_mined_triplets", views=VIEWS, sql=_MINED_SQL)
def g_mined_triplets(spark, sf):
    cat = _cat(spark, sf)
    q = view(spark, sf, "search_queries")
    parts = Parts(dim=DIM)
    hits = vectors.knn(parts.queries(q, "query_id", "search_query"), parts.catalog(cat, "commodity_code", "corpus"), 50).join(
        shuffled(cat.select(F.col("commodity_code").alias("doc_id"), "corpus", "commodity_name")), "doc_id")
    return G.mined_triplets(hits, q)


@register("g_query_groups", views=("search_queries",), sql="""
SELECT search_query AS query, commodity_name AS label, count(*) AS size FROM search_queries
GROUP BY search_query, commodity_name""")
def g_query_groups(spark, sf):
    return G.query_groups(view(spark, sf, "search_queries"))
