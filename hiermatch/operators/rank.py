"""Fusion, re-scoring and score merging.

All per-query steps are windows partitioned by ``query_id``; once the
candidates are hash-partitioned by query, none of them shuffles again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path, shuffled

ALPHA = 0.4
BETA = 0.6


def fuse(sem: DataFrame, lex: DataFrame, catalog: DataFrame, key: str = "text", text_col: str = "corpus") -> DataFrame:
    """Union of the semantic and lexical top-k lists per query.

    ``sem``: (query_id, doc_id, sem_score, sem_rank); ``lex``: (query_id, doc_id, lex_score, lex_rank);
    ``catalog``: doc_id plus the columns to carry (must include ``text_col``).
    Candidates are keyed by document text (``key='text'``, rows sharing a text collapse, the
    lowest id represents them, each side keeps its last-ranked score) or by id (``key='code'``).
    A side that did not return the candidate scores 0.0.  ``cand_pos`` orders semantic hits by
    their rank, then lexical-only hits by theirs.
    """
    s = sem.select("query_id", "doc_id", "sem_score", "sem_rank")
    lx = lex.select("query_id", "doc_id", "lex_score", "lex_rank")
    # Only ids, scores and the key travel through the aggregation; the catalog's columns join afterwards.
    known = catalog.select("doc_id", *([F.col(text_col).alias("_text")] if key == "text" else []))
    return _fused(s.unionByName(lx, allowMissingColumns=True).join(shuffled(known), "doc_id"), catalog, key)


#: Rows of :func:`twins` that are sent to every task.
FEW_TWINS = 50_000


def twins(catalog: DataFrame, text_col: str = "corpus") -> DataFrame:
    """(doc_id, _text) of the catalog's rows that share their id or their text with another; written."""
    spark = catalog.sparkSession
    rows = catalog.select("doc_id", F.col(text_col).alias("_text"), F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)).alias("_h"))
    often = lambda c: shuffled(rows.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1").select(c, F.lit(True).alias(f"_often{c}")))
    both = rows.join(often("doc_id"), "doc_id", "left").join(often("_h"), "_h", "left").where("_oftendoc_id or _often_h").select("doc_id", "_text")
    path = shared_path(spark, "twins")
    both.write.parquet(path)
    return spark.read.schema(both.schema).parquet(path)


def fuse_lists(sem: DataFrame, lex: DataFrame, catalog: DataFrame, same: DataFrame) -> DataFrame:
    """:func:`fuse` by text, of lists: ``sem`` (query_id, doc_id, sem_score, sem_rank) and ``lex`` as arrays, a row a query.

    All ids are of ``catalog``, and ``same`` are its :func:`twins`: any other row has a text of its own, so that only
    lists are shuffled before the aggregation, once, and no text.
    """
    both = sem.select("query_id", F.lit(True).alias("_sem"), "doc_id", F.col("sem_score").alias("_s"), F.col("sem_rank").alias("_r")).unionByName(
        lex.select("query_id", F.lit(False), "doc_id", "lex_score", "lex_rank").toDF("query_id", "_sem", "doc_id", "_s", "_r"))
    u = both.repartition("query_id").select("query_id", "_sem", F.inline(F.arrays_zip("doc_id", "_s", "_r"))).where("doc_id is not null")
    mine = lambda c, sem: F.when(F.col("_sem") == F.lit(sem), F.col(c))
    u = u.select("query_id", "doc_id", mine("_s", True).alias("sem_score"), mine("_r", True).alias("sem_rank"), mine("_s", False).alias("lex_score"), mine("_r", False).alias("lex_rank"))
    side = F.broadcast(same) if same.limit(FEW_TWINS + 1).count() <= FEW_TWINS else shuffled(same)
    return _fused(u.join(side, "doc_id", "left"), catalog, "text")


def _fused(u: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    # A row without text stands for itself.
    by = [F.col("_text"), F.when(F.col("_text").isNull(), F.col("doc_id")).alias("_id")] if key == "text" else [F.col("doc_id").alias("_id")]
    g = u.groupBy("query_id", *by).agg(
        F.min("doc_id").alias("doc_id"),
        F.min("sem_rank").alias("sem_rank"),
        F.min("lex_rank").alias("lex_rank"),
        F.min("sem_score").alias("sem_score"),
        F.min("lex_score").alias("lex_score"),
    )
    w = Window.partitionBy("query_id").orderBy(
        F.col("sem_rank").isNull().asc(), F.col("sem_rank").asc(), F.col("lex_rank").asc(), F.col("doc_id").asc())
    g = g.select(
        "query_id", "doc_id",
        F.coalesce("sem_score", F.lit(0.0)).alias("sem_score"),
        F.coalesce("lex_score", F.lit(0.0)).alias("lex_score"),
        "sem_rank", "lex_rank",
    ).withColumn("cand_pos", F.row_number().over(w))
    return g.join(shuffled(catalog), "doc_id")


def uniform_rows(cands: DataFrame, cols: list[str], scores: bool = True) -> DataFrame:
    """Candidates of any retriever as (query_id, doc_id, cand_pos, cols..., sem_score, lex_score).  Without
    ``scores`` the candidates' own are left out; those of a retriever that gives none are 0."""
    both = ["sem_score", "lex_score"]
    given = [c for c in both if c in cands.columns]
    return cands.select("query_id", "doc_id", "cand_pos", *cols, *(both if scores else [F.lit(0.0).alias(c) for c in both if not given]))


def candidate_counts(cands: DataFrame) -> DataFrame:
    """Candidates per query."""
    return cands.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_candidates"))


def token_cosine(q_tokens: Column, d_tokens: Column) -> Column:
    """X1 built-in pair scorer: |Q ∩ D| / sqrt(|Q| |D|) over distinct tokens; 0 when either side is empty."""
    qd = F.array_distinct(q_tokens)
    dd = F.array_distinct(d_tokens)
    denom = F.sqrt(F.size(qd).cast("double") * F.size(dd).cast("double"))
    return F.when(denom > 0, F.size(F.array_intersect(qd, dd)) / denom).otherwise(F.lit(0.0))


def pair_scores_with(pairs: DataFrame, query_col: str, doc_col: str, model_factory, out_col: str = "cross_score",
                     batch_rows: int = 256) -> DataFrame:
    """X1 with a pluggable pair model: ``model_factory()`` (in each task; a ``parts.Model`` loads once per worker) returns
    ``score(list[str], list[str]) -> array[n]``; pairs travel as Arrow batches."""
    schema = T.StructType(pairs.schema.fields + [T.StructField(out_col, T.DoubleType())])

    def run(it):
        score = model_factory()
        for pdf in it:
            qs = pdf[query_col].fillna("").astype(str).tolist()
            ds = pdf[doc_col].fillna("").astype(str).tolist()
            out = []
            for s in range(0, len(qs), batch_rows):
                out.append(np.asarray(score(qs[s:s + batch_rows], ds[s:s + batch_rows]), dtype=np.float64))
            pdf[out_col] = np.concatenate(out) if out else pd.Series([], dtype="float64")
            yield pdf

    return pairs.mapInPandas(run, schema)


def pair_score_column(model_factory, batch_rows: int = 256):
    """X1 with a pluggable pair model as a function of two text columns: only these travel, and rows stay where they are."""
    @F.pandas_udf("double")
    def scores(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        score = model_factory()
        for pair in it:
            qs, ds = (t.fillna("").astype(str).tolist() for t in pair)
            out = [np.asarray(score(qs[s:s + batch_rows], ds[s:s + batch_rows]), dtype=np.float64) for s in range(0, len(qs), batch_rows)]
            yield pd.Series(np.concatenate([*out, np.zeros(0)]))

    return scores


def rerank(cands: DataFrame, n: int = 20, score_col: str = "cross_score", pos_col: str = "cand_pos") -> DataFrame:
    """X1 cut / X4: stable descending sort on the pair score, keep the first ``n``."""
    w = Window.partitionBy("query_id").orderBy(F.round(F.col(score_col), 9).desc(), F.col(pos_col).asc())
    return cands.withColumn("rerank_pos", F.row_number().over(w)).filter(F.col("rerank_pos") <= n)


def minmax(c: Column, part: str = "query_id") -> Column:
    """Per-query min-max; all-equal -> 1.0.  Scores are rounded to 9 places first, so sums that differ in
    their last bit are equal."""
    w = Window.partitionBy(part)
    c = F.round(c, 9)
    lo = F.min(c).over(w)
    hi = F.max(c).over(w)
    return F.when(hi - lo == 0, F.lit(1.0)).otherwise((c - lo) / (hi - lo))


def merge(cands: DataFrame, alpha: float = ALPHA, beta: float = BETA) -> DataFrame:
    """final = alpha * minmax(sem + lex) + beta * minmax(cross), over the rows present."""
    return (
        cands.withColumn("hybrid_norm", minmax(F.col("sem_score") + F.col("lex_score")))
        .withColumn("cross_norm", minmax(F.col("cross_score")))
        .withColumn("final_score", F.lit(alpha) * F.col("hybrid_norm") + F.lit(beta) * F.col("cross_norm"))
    )


def top_n(df: DataFrame, n: int, order: list, part: str = "query_id", rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per query under an explicit total order."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
