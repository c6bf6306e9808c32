"""DuckDB SQL fragments for the differential oracle.

These mirror the Column builders in :mod:`hiermatch.functions` in DuckDB's
dialect (RE2 regex with the ``'g'`` flag, ``lambda x:`` syntax, ``||`` for
null-propagating concatenation).  They exist only to produce ``oracle_sql()``
text; nothing in the library executes them.
"""

from __future__ import annotations

from ..functions.features import KEYWORDS, MATERIALS, SPECS
from ..functions.text import ABBREVIATIONS, TOKEN_MAP
from ..operators.lexical import B, EPSILON, K1


#: The blanks of functions.text.SPACE in RE2's dialect.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(x: str, mapping=ABBREVIATIONS, drop_runs: int | None = None) -> str:
    e = f"lower(coalesce({x}, ''))"
    for src, dst in mapping:
        e = f"replace({e}, {q(src)}, {q(dst)})"
    if drop_runs:
        e = f"regexp_replace({e}, '\\b[a-z0-9]{{{drop_runs},}}\\b', '', 'g')"
    e = f"regexp_replace({e}, '[^a-z0-9\\s]', ' ', 'g')"
    e = f"regexp_replace({e}, '\\s+', ' ', 'g')"
    return f"trim({e})"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{SPACE}+'), lambda t: t <> '')"


def clean_tokens(x: str) -> str:
    return tokens(clean(x))


def token_map(x: str) -> str:
    """T5."""
    mapped = "CASE " + " ".join(f"WHEN t = {q(k)} THEN {q(v)}" for k, v in TOKEN_MAP) + " ELSE t END"
    e = f"array_to_string(list_transform({tokens(f'lower({x})')}, lambda t: {mapped}), ' ')"
    return f"trim(regexp_replace(regexp_replace({e}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def split_tokens(x: str) -> str:
    return tokens(f"lower(coalesce({x}, ''))")


def corpus(seg="segment_name", fam="family_name", cls="class_name", com="commodity_name") -> str:
    return f"lower({seg} || ' ' || {fam} || ' ' || {cls} || ' ' || {com})"


def name_key_ascii(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '[^a-zA-Z0-9_]+', ' ', 'g')))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def join_key(x: str) -> str:
    return f"lower({strip(x)})"


def material_cols(x: str) -> list[str]:
    return [f"CAST(regexp_matches(lower(coalesce({x}, '')), {q(p)}) AS DOUBLE) AS {n}" for n, p in MATERIALS]


def spec_cols(x: str) -> list[str]:
    out = []
    for n, p in SPECS:
        g = f"regexp_extract(coalesce({x}, ''), {q(p)}, 1, 'i')"
        out.append(f"CAST({g} <> '' AS DOUBLE) AS {n}_flag")
        out.append(f"coalesce(TRY_CAST({g} AS DOUBLE), 0.0) AS {n}_value")
    return out


def keyword_cols(x: str) -> list[str]:
    out = []
    for n, words in KEYWORDS:
        cond = " OR ".join(f"contains(lower(coalesce({x}, '')), {q(w)})" for w in words)
        out.append(f"CAST(({cond}) AS DOUBLE) AS kw_{n}")
    return out


def feature_exprs(x: str) -> list[str]:
    """The 21 feature expressions without aliases, in vector order."""
    return [c.rsplit(" AS ", 1)[0] for c in material_cols(x) + spec_cols(x) + keyword_cols(x)]


def feature_vector(x: str) -> str:
    return "[" + ", ".join(feature_exprs(x)) + "]::DOUBLE[]"


def bm25_ctes(docs: str, doc_id: str, doc_text: str, queries: str, qid: str, qtext: str, tok=clean_tokens,
              prefix: str = "") -> str:
    """CTEs ending in ``{prefix}scores(query_id, doc_id, score)``."""
    p = prefix
    return f"""
{p}dtok AS (SELECT {doc_id} AS doc_id, {tok(doc_text)} AS toks FROM {docs}),
{p}stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {p}dtok),
{p}post AS (SELECT token, doc_id, dl, count(*) AS tf FROM
    (SELECT doc_id, len(toks) AS dl, unnest(toks) AS token FROM {p}dtok) GROUP BY token, doc_id, dl),
{p}dfs AS (SELECT token, count(*) AS df FROM {p}post GROUP BY token),
{p}idf0 AS (SELECT token, df, ln(s.n - df + 0.5) - ln(df + 0.5) AS raw FROM {p}dfs, {p}stats s),
{p}midf AS (SELECT avg(raw) AS m FROM {p}idf0),
{p}idf AS (SELECT token, df, CASE WHEN raw < 0 THEN {EPSILON} * m ELSE raw END AS idf FROM {p}idf0, {p}midf),
{p}wts AS (SELECT p.token, p.doc_id, p.tf, p.dl, i.idf,
    i.idf * p.tf * {K1 + 1.0} / (p.tf + {K1} * ({1.0 - B} + {B} * p.dl / s.avgdl)) AS w
    FROM {p}post p JOIN {p}idf i ON p.token = i.token, {p}stats s),
{p}qt AS (SELECT query_id, token, count(*) AS qtf FROM
    (SELECT {qid} AS query_id, unnest({tok(qtext)}) AS token FROM {queries}) GROUP BY query_id, token),
{p}scores AS (SELECT qt.query_id, w.doc_id, sum(qt.qtf * w.w) AS score
    FROM {p}qt qt JOIN {p}wts w ON qt.token = w.token GROUP BY qt.query_id, w.doc_id)"""


def hash_embed(x: str, dim: int, tok=None) -> str:
    """Hashed bag-of-tokens, L2-normalised, as DOUBLE[] (mirrors functions.embed.hash_embed)."""
    toks = tok(x) if tok else (
        f"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[^a-z0-9]+'), lambda t: t <> '')"
    )
    buckets = f"list_transform({toks}, lambda t: (('0x' || substr(md5(t), 1, 4))::INTEGER % {dim}))"
    counts = f"list_transform(range({dim}), lambda i: CAST(len(list_filter({buckets}, lambda b: b = i)) AS DOUBLE))"
    return counts


def round6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


TOKEN_MAP_SQL = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in TOKEN_MAP) + "}"


def l2norm_sql(counts: str) -> str:
    """Normalise a DOUBLE[] of counts to unit length (zeros stay zeros)."""
    return (f"list_transform({counts}, lambda x: CASE WHEN sqrt(list_sum(list_transform({counts}, lambda y: y * y))) > 0 "
            f"THEN x / sqrt(list_sum(list_transform({counts}, lambda y: y * y))) ELSE 0.0 END)")


def sqdist(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def norm_sql(a: str) -> str:
    return f"sqrt(list_sum(list_transform({a}, lambda x: x * x)))"


def classify_ctes(products: str = "products", catalog: str = "catalog", retrieve_k: int = 50, rerank_k: int = 20,
                  use_hierarchy: bool = True, use_features: bool = True, key: str = "text", dim: int = 64,
                  alpha: float = 0.4, beta: float = 0.6, boost: float = 1.3, route_top: int = 5, tok=clean_tokens,
                  clean=clean, embed=None, cross=None, features=feature_vector, n_features: int = 21) -> str:
    """CTE chain for the batch classifier; defines cat, fused (candidates), scored, preds.

    ``tok``, ``clean``, ``embed`` (whole vector), ``cross`` (of query and catalog text) and ``features`` take and give
    SQL, for the classifier's replaceable parts.
    """
    vec = embed or (lambda x: hash_embed(x, dim))
    unit = l2norm_sql if embed is None else (lambda c: c)
    cross_sql = cross and cross("pq.description", "f.corpus")
    key_expr = "corpus" if key == "text" else "CAST(doc_id AS VARCHAR)"
    parts = [f"""
cat AS (SELECT commodity_code, segment_name, family_name, class_name, commodity_name, {corpus()} AS corpus
        FROM {catalog}),
{bm25_ctes("cat", "commodity_code", "corpus", products, "product_id", "description", tok=tok, prefix="c_").strip()},
lex AS (SELECT query_id, doc_id, score AS lex_score, rk AS lex_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rk FROM c_scores)
        WHERE rk <= {retrieve_k}),
qv0 AS (SELECT product_id AS query_id, {vec(clean("description"))} AS c FROM {products}),
qv AS (SELECT query_id, {unit("c")} AS v FROM qv0),
cv0 AS (SELECT commodity_code AS doc_id, {vec("corpus")} AS c FROM cat),
cv AS (SELECT doc_id, {unit("c")} AS v FROM cv0),
dist AS (SELECT qv.query_id, cv.doc_id, {sqdist("qv.v", "cv.v")} AS d FROM qv, cv),
sem AS (SELECT query_id, doc_id, 1.0 / (1.0 + d) AS sem_score, rk AS sem_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), doc_id) AS rk FROM dist)
        WHERE rk <= {retrieve_k}),
u AS (SELECT query_id, doc_id, sem_score, sem_rank, CAST(NULL AS DOUBLE) AS lex_score, CAST(NULL AS BIGINT) AS lex_rank
      FROM sem UNION ALL
      SELECT query_id, doc_id, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), lex_score, lex_rank FROM lex),
uc AS (SELECT u.*, cat.corpus FROM u JOIN cat ON u.doc_id = cat.commodity_code),
g AS (SELECT query_id, min(doc_id) AS doc_id, min(sem_rank) AS sem_rank, min(lex_rank) AS lex_rank,
             coalesce(min(sem_score), 0.0) AS sem_score, coalesce(min(lex_score), 0.0) AS lex_score
      FROM uc GROUP BY query_id, {key_expr}),
fused AS (SELECT g.*, c.commodity_code, c.commodity_name, c.segment_name, c.family_name, c.class_name, c.corpus,
                 row_number() OVER (PARTITION BY g.query_id ORDER BY (g.sem_rank IS NULL), g.sem_rank, g.lex_rank,
                                    g.doc_id) AS cand_pos
          FROM g JOIN cat c ON c.commodity_code = g.doc_id),
pq AS (SELECT product_id AS query_id, description, list_distinct({tok("description")}) AS qt FROM {products}),
x AS (SELECT f.*, pq.description,
             {cross_sql or f"""CASE WHEN len(pq.qt) * len(list_distinct({tok("f.corpus")})) > 0
                  THEN len(list_intersect(pq.qt, list_distinct({tok("f.corpus")})))
                       / sqrt(CAST(len(pq.qt) AS DOUBLE) * len(list_distinct({tok("f.corpus")})))
                  ELSE 0.0 END"""} AS cross_score
      FROM fused f JOIN pq ON f.query_id = pq.query_id),
rr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cross_score, 9) DESC, cand_pos)
       AS rerank_pos FROM x) WHERE rerank_pos <= {rerank_k}),
mm AS (SELECT *, round(sem_score + lex_score, 9) AS hy, round(cross_score, 9) AS cr,
              min(round(sem_score + lex_score, 9)) OVER (PARTITION BY query_id) AS hy_lo,
              max(round(sem_score + lex_score, 9)) OVER (PARTITION BY query_id) AS hy_hi,
              min(round(cross_score, 9)) OVER (PARTITION BY query_id) AS cr_lo,
              max(round(cross_score, 9)) OVER (PARTITION BY query_id) AS cr_hi FROM rr),
merged AS (SELECT *, CASE WHEN hy_hi - hy_lo = 0 THEN 1.0 ELSE (hy - hy_lo) / (hy_hi - hy_lo) END AS hybrid_norm,
                  CASE WHEN cr_hi - cr_lo = 0 THEN 1.0 ELSE (cr - cr_lo) / (cr_hi - cr_lo) END AS cross_norm
           FROM mm),
merged2 AS (SELECT *, {alpha} * hybrid_norm + {beta} * cross_norm AS final_score FROM merged)"""]
    if use_hierarchy:
        parts.append(f"""
e_sf AS (SELECT DISTINCT segment_name AS p, family_name AS c FROM cat),
e_fc AS (SELECT DISTINCT family_name AS p, class_name AS c FROM cat),
e_cc AS (SELECT DISTINCT class_name AS p, commodity_name AS c FROM cat),
reach AS (SELECT DISTINCT e_sf.p AS segment_name, e_cc.c AS commodity_name
          FROM e_sf JOIN e_fc ON e_sf.c = e_fc.p JOIN e_cc ON e_fc.c = e_cc.p),
ev AS (SELECT DISTINCT query_id, segment_name FROM fused WHERE cand_pos <= {route_top} AND segment_name <> ''),
inh AS (SELECT DISTINCT ev.query_id, r.commodity_name FROM ev JOIN reach r ON r.segment_name = ev.segment_name),
boosted AS (SELECT m.*, (inh.query_id IS NOT NULL) AS in_hierarchy,
                   m.final_score * CASE WHEN inh.query_id IS NOT NULL THEN {boost} ELSE 1.0 END AS boosted_score
            FROM merged2 m LEFT JOIN inh ON inh.query_id = m.query_id AND inh.commodity_name = m.commodity_name)""")
    else:
        parts.append("""
boosted AS (SELECT *, false AS in_hierarchy, final_score AS boosted_score FROM merged2)""")
    if use_features:
        zeros = "[" + ", ".join(["0.0"] * n_features) + "]::DOUBLE[]"
        parts.append(f"""
catf AS (SELECT commodity_name, arg_max({features("corpus")}, commodity_code) AS cf FROM cat GROUP BY commodity_name),
fb AS (SELECT b.*, {features("b.description")} AS pf, coalesce(catf.cf, {zeros}) AS cf2
       FROM boosted b LEFT JOIN catf ON catf.commodity_name = b.commodity_name),
scored AS (SELECT *, 1.0 - {norm_sql("list_transform(list_zip(pf, cf2), lambda p: p[1] - p[2])")}
                      / (1.0 + {norm_sql("pf")} + {norm_sql("cf2")}) AS feature_sim FROM fb),
scored2 AS (SELECT *, 0.7 * boosted_score + 0.3 * feature_sim AS final_boosted_score FROM scored)""")
    else:
        parts.append("""
scored2 AS (SELECT *, boosted_score AS final_boosted_score FROM boosted)""")
    parts.append(f"""
preds AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(final_boosted_score, 9) DESC,
            round(boosted_score, 9) DESC, round(final_score, 9) DESC, round(cross_score, 9) DESC, cand_pos) AS rank
          FROM scored2))""")
    return ",".join(parts)


PRED_COLS = (f"query_id AS product_id, CAST(rank AS INTEGER) AS rank, CAST(commodity_code AS BIGINT) AS commodity_code, "
             f"commodity_name, {round6('final_boosted_score')} AS score, segment_name AS segment, family_name AS family, "
             f"class_name AS class, in_hierarchy")
