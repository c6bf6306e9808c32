"""Exact BM25 top-k by score bounds of groups of documents (R2, R3), for catalogs where hardly a word is selective.

Tokens that more than a 2^-level share of the documents have are common; documents with the same common tokens, counts
and length are one group, so the common tokens add the same to the score of each of them.  Rare tokens weigh at
least 0 and only add to it, at most their largest weight in the group.  Per query this gives

1. for every group the common part, which all its documents reach, and the most that one of them may reach;
2. the score that k documents surely reach: the common part of the group at which the k-th document is met;
3. the groups whose most reaches that score.  In these, documents with a rare token of the query are looked up by
   (token, group); of the others, which all score the common part, the k smallest ids stand for the group.

The level is the finest one whose groups stay few beside the documents, counted when the index is built, so what a
query meets grows with the groups and with the documents that can win, not with the catalog.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_token_list
from ..session import shared_path
from .lexical import LexicalIndex, query_terms, top_k

#: Levels tried: common tokens are in more than 1/2, 1/4, ... of the documents.
LEVELS = range(1, 11)
_SLACK = 1e-6  # far above rounding errors of a sum of weights


@dataclass
class GroupedIndex:
    bounds: DataFrame  # token, group_id, n (documents of the group), common, w (the common token's weight, or the rare one's largest)
    places: DataFrame  # token, group_id, doc_id, w of rare tokens; and with an empty token every document, nth in its group by id
    terms: DataFrame  # token, common


def most_groups(n_docs: int) -> int:
    """Groups that an index may have: sixteen times the square root of the documents, 256 at least."""
    return max(256, int(16 * n_docs ** 0.5))


def group_index(index: LexicalIndex, path: str | None = None, groups: int | None = None) -> GroupedIndex:
    """Write the grouped form of ``index`` below ``path`` (default: a new shared folder) and open it.

    ``groups`` overrides the number of groups allowed; it moves work between steps and never changes results.
    """
    spark = index.weights.sparkSession
    path = path or shared_path(spark, "grouped-index")
    n_docs = index.stats.first()["n_docs"] or 0
    rows = index.weights.select("token", "doc_id", "dl", "tf", "w").join(index.idf.select("token", "df"), "token")
    share = lambda level: F.col("df") > F.lit(n_docs / 2 ** level)
    of_doc = F.array_sort(F.collect_list(F.when(share(max(LEVELS)), F.struct("token", "tf", "df"))))
    rows.groupBy("doc_id", "dl").agg(of_doc.alias("tokens")).write.parquet(f"{path}/documents")
    docs = spark.read.parquet(f"{path}/documents")
    profile = lambda level: F.transform(F.filter("tokens", lambda t: t["df"] > F.lit(n_docs / 2 ** level)), lambda t: F.struct(t["token"], t["tf"]))
    counts = docs.agg(*(F.approx_count_distinct(F.xxhash64("dl", profile(j))).alias(f"n{j}") for j in LEVELS)).first()
    few = [j for j in LEVELS if counts[f"n{j}"] <= (groups or most_groups(n_docs))]
    level = max(few, default=min(LEVELS))
    keyed = docs.select("doc_id", F.struct("dl", profile(level).alias("p")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("n"))
    members = keyed.join(sizes, "key").select("doc_id", "group_id", "n")
    members.write.parquet(f"{path}/members")
    members = spark.read.parquet(f"{path}/members")
    placed = rows.join(members, "doc_id").withColumn("common", share(level))
    placed.groupBy("token", "group_id", "n", "common").agg(F.max("w").alias("w")).write.parquet(f"{path}/bounds")
    nth = F.row_number().over(Window.partitionBy("group_id").orderBy("doc_id"))
    every = members.select(F.lit("").alias("token"), "group_id", "doc_id", F.lit(0.0).alias("w"), nth.alias("nth"))
    rare = placed.where("not common").select("token", "group_id", "doc_id", "w", F.lit(0).alias("nth"))
    rare.unionByName(every).write.parquet(f"{path}/places")
    index.idf.select("token", share(level).alias("common")).write.parquet(f"{path}/terms")
    return read_groups(spark, path)


def read_groups(spark: SparkSession, path: str) -> GroupedIndex:
    """The index that :func:`group_index` wrote."""
    return GroupedIndex(*(spark.read.parquet(f"{path}/{t}") for t in ("bounds", "places", "terms")))


def reachable_groups(terms: DataFrame, index: GroupedIndex, k: int) -> DataFrame:
    """(query_id, group_id, base, whole, goal): the groups that may hold one of a query's k best documents; ``base`` is
    their common part, ``whole`` whether documents without any rare token of the query may be among the k best, and
    ``goal`` the score that k documents reach (null if fewer share a common token)."""
    if_common = lambda c: F.when(F.col("common"), c)
    part = F.col("qtf") * F.col("w")
    reach = terms.select("query_id", "token", "qtf").join(index.bounds, "token").groupBy("query_id", "group_id").agg(
        F.first("n").alias("n"), F.sum(if_common(part)).alias("base"), F.sum(F.when(~F.col("common"), part)).alias("rare"))
    best_first = Window.partitionBy("query_id").orderBy(F.col("base").desc_nulls_last(), F.col("group_id")).rowsBetween(Window.unboundedPreceding, 0)
    met = F.sum(F.when(F.col("base").isNotNull(), F.col("n"))).over(best_first)
    reach = reach.withColumn("met", met)
    goal = F.max(F.when(F.col("met") >= k, F.col("base"))).over(Window.partitionBy("query_id")) - F.lit(_SLACK)
    reach = reach.withColumn("goal", goal)
    base, rare = F.coalesce("base", F.lit(0.0)), F.coalesce("rare", F.lit(0.0))
    whole = F.col("base").isNotNull() & (F.col("goal").isNull() | (F.col("base") >= F.col("goal")))
    return reach.where(F.col("goal").isNull() | (base + rare >= F.col("goal"))).select("query_id", "group_id", base.alias("base"), whole.alias("whole"), "goal")


def candidates(queries: DataFrame, qid_col: str, text_col: str, index: GroupedIndex, k: int, tokenizer=clean_token_list) -> DataFrame:
    """(query_id, doc_id, score): documents that hold every query's k best; the scores are exact."""
    terms = query_terms(queries, qid_col, text_col, tokenizer).join(index.terms, "token")
    rare = terms.groupBy("query_id").agg(F.collect_list(F.when(~F.col("common"), F.struct("token", "qtf"))).alias("rare"))
    reach = reachable_groups(terms, index, k).join(rare, "query_id")
    every = F.when(F.col("whole"), F.array(F.struct(F.lit("").alias("token"), F.lit(0).cast("long").alias("qtf")))).otherwise(F.array())
    wanted = reach.select("query_id", "group_id", "base", "goal", F.explode(F.concat("rare", every)).alias("t"))
    hits = wanted.select("query_id", "group_id", "base", "goal", "t.token", "t.qtf").join(index.places.where(F.col("nth") <= k), ["token", "group_id"])
    scores = hits.groupBy("query_id", "doc_id").agg((F.first("base") + F.sum(F.col("qtf") * F.col("w"))).alias("score"), F.first("goal").alias("goal"))
    return scores.where("goal is null or score >= goal").select("query_id", "doc_id", "score")


def bm25_topk_grouped(queries: DataFrame, qid_col: str, text_col: str, index: GroupedIndex, k: int, tokenizer=clean_token_list) -> DataFrame:
    """R2 + R3: (query_id, doc_id, score, rank); the same rows as :func:`lexical.bm25_topk`."""
    return top_k(candidates(queries, qid_col, text_col, index, k, tokenizer), k)
