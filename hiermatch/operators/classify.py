"""Batch classification (C1-C5): every product of a table in one plan.

Plan, per product (``query_id``):

1. lexical top-``retrieve_k`` over the cleaned description (BM25 index of the cleaned corpus);
2. semantic top-``retrieve_k``: embedding of the cleaned description vs embedding of the raw corpus;
3. fuse both lists (R10) and attach the enriched catalog row once (join on code);
4. route: evidence segments of the first 5 fused candidates (window, no shuffle);
5. re-score pairs on the raw description, keep ``rerank_k`` (X1);
6. min-max merge (X2/X3), hierarchy boost (H8), feature blend (F6/F7);
7. top ``top_k`` under the stable-sort order of the reference.

After step 3 every operator is a window partitioned by ``query_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embed import DIM
from ..functions.features import feature_similarity, feature_vector
from ..functions.text import clean_token_list, corpus
from ..session import shared_path, shuffled
from . import hierarchy, lexical, rank, vectors
from .parts import Parts
from .position import row_position


# The defaults that the results are compared at.
@dataclass(frozen=True)
class ClassifyConfig:
    top_k: int = 10
    retrieve_k: int = 50
    rerank_k: int = 20
    route_top: int = 5
    boost: float = 1.3
    alpha: float = rank.ALPHA
    beta: float = rank.BETA
    feature_weight: float = 0.3
    use_hierarchy: bool = True
    use_features: bool = True
    key: str = "text"
    embed_dim: int = DIM


def with_corpus(catalog: DataFrame) -> DataFrame:
    """The catalog with its derived ``corpus``."""
    if "corpus" in catalog.columns:
        return catalog
    return catalog.withColumn("corpus", corpus("segment_name", "family_name", "class_name", "commodity_name"))


def catalog_features(catalog: DataFrame, pos_col: str | None = None, extractor=feature_vector) -> DataFrame:
    """feature vector of the corpus per commodity name, last row wins."""
    c = with_corpus(catalog)
    # Only the row that wins is extracted from.
    last = c.groupBy("commodity_name").agg(F.max_by(F.struct("corpus"), row_position(c, pos_col)).alias("last"))
    # Null where no row has a position; not by ``when``, inside which Spark works common parts out again and again.
    features = F.get(F.array(extractor(F.col("last.corpus"))), F.col("last").isNull().cast("int"))
    return last.select("commodity_name", features.alias("cat_features"))


def enriched_catalog(catalog: DataFrame, cfg: ClassifyConfig = ClassifyConfig(), parts: Parts = Parts()) -> DataFrame:
    """One row per catalog entry with everything the per-query stages read.

    Built once per catalog (persist or write it): corpus, names, distinct corpus tokens for the
    pair scorer, feature vector (F5, by name) and the segments whose closure reaches the name.
    """
    # Dealt by code first and split into words last: one unsplit file is still worked on by many tasks.
    c = with_corpus(catalog.repartition("commodity_code"))
    names = ["commodity_name", "segment_name", "family_name", "class_name"]
    out = c.select(F.col("commodity_code").alias("doc_id"), "commodity_code", *names, "corpus")
    if cfg.use_features:
        out = out.join(shuffled(catalog_features(c, extractor=parts.extractor)), "commodity_name", "left")
    if cfg.use_hierarchy:
        out = out.join(shuffled(hierarchy.reach_segments(c)), "commodity_name", "left")
    return out.withColumn("doc_tokens", F.array_distinct(parts.tokens("corpus")))


def retrieve(products: DataFrame, catalog: DataFrame, cfg: ClassifyConfig = ClassifyConfig(),
             index: lexical.LexicalIndex | lexical.ForwardIndex | None = None, catalog_vectors: vectors.VectorIndex | None = None,
             enriched: DataFrame | None = None, desc_col: str = "description", parts: Parts | None = None,
             twins: DataFrame | None = None) -> DataFrame:
    """R10 + R11: fused candidates per product with their catalog row attached.  ``twins`` are those of ``enriched``, if
    all prebuilt tables are of one catalog."""
    whole = twins is not None or (index is None and catalog_vectors is None and enriched is None)
    c = with_corpus(catalog)
    q = products.select(F.col("product_id").alias("query_id"), F.col(desc_col).alias("description"))
    parts = parts or Parts(dim=cfg.embed_dim)
    if index is None:
        index = lexical.build_forward_index(c, "commodity_code", "corpus", parts.tokens)
    lex = lexical.bm25_lists_dense(q, "query_id", "description", index, cfg.retrieve_k, parts.tokens).select(
        "query_id", "doc_id", F.col("score").alias("lex_score"), F.col("rank").alias("lex_rank"))
    qv = parts.queries(q, "query_id", "description")
    if catalog_vectors is None:
        catalog_vectors = vectors.cluster(parts.catalog(c, "commodity_code", "corpus"))
    sem = vectors.knn_lists(qv, None, cfg.retrieve_k, index=catalog_vectors).select(
        "query_id", "doc_id", F.transform("distance", vectors.similarity).alias("sem_score"), F.col("rank").alias("sem_rank"))
    if enriched is None:
        path = shared_path(q.sparkSession, "enriched-catalog")  # read twice below
        enriched_catalog(c, cfg, parts).write.parquet(path)
        enriched = q.sparkSession.read.parquet(path)
    if whole and cfg.key == "text":
        return rank.fuse_lists(sem, lex, enriched, rank.twins(enriched) if twins is None else twins)
    sem, lex = (x.select("query_id", F.inline(F.arrays_zip(*x.columns[1:]))) for x in (sem, lex))
    return rank.fuse(sem, lex, enriched, key=cfg.key)


def prebuild(catalog: DataFrame, path: str, cfg: ClassifyConfig = ClassifyConfig(), parts: Parts | None = None) -> dict:
    """Write the BM25 index, the clustered catalog vectors and the enriched catalog under ``path``, once per
    catalog; the result (or :func:`prebuilt`) goes to :func:`classify_batch` as keywords, with the same ``parts``."""
    c, parts = with_corpus(catalog), parts or Parts(dim=cfg.embed_dim)
    lexical.build_forward_index(c, "commodity_code", "corpus", parts.tokens, f"{path}/lexical")
    vectors.cluster(parts.catalog(c, "commodity_code", "corpus"), path=f"{path}/vectors")
    enriched_catalog(c, cfg, parts).write.parquet(f"{path}/enriched")
    rank.twins(catalog.sparkSession.read.parquet(f"{path}/enriched")).write.parquet(f"{path}/twins")
    return prebuilt(catalog.sparkSession, path)


def prebuilt(spark: SparkSession, path: str) -> dict:
    """The tables that :func:`prebuild` wrote."""
    return {"index": lexical.read_forward_index(spark, f"{path}/lexical"), "catalog_vectors": vectors.read_vectors(spark, f"{path}/vectors"),
            "enriched": spark.read.parquet(f"{path}/enriched"), "twins": spark.read.parquet(f"{path}/twins")}


def score_candidates(cands: DataFrame, products: DataFrame, cfg: ClassifyConfig = ClassifyConfig(),
                     desc_col: str = "description", parts: Parts = Parts()) -> DataFrame:
    """Steps 4-6 on fused candidates: routing evidence, pair score, cut, merge, boost, blend."""
    # Per-product values are computed once per product, before the join fans them out to candidates.
    per_product = [F.array_distinct(parts.tokens("description")).alias("_q_tokens")]
    if cfg.use_features:
        per_product.append(parts.extractor(F.col("description")).alias("_q_features"))
    p = products.select(F.col("product_id").alias("query_id"), F.col(desc_col).alias("description")) \
                .select("query_id", "description", *per_product)
    x = cands.join(shuffled(p), "query_id")
    if cfg.use_hierarchy:
        x = hierarchy.evidence_segments(x, cfg.route_top)
    x = parts.pair_scores(x)
    x = rank.rerank(x, cfg.rerank_k)
    x = rank.merge(x, cfg.alpha, cfg.beta)
    if cfg.use_hierarchy:
        x = hierarchy.boost(x, cfg.boost)
    else:
        x = x.withColumn("in_hierarchy", F.lit(False)).withColumn("hierarchy_boost", F.lit(1.0)) \
             .withColumn("boosted_score", F.col("final_score"))
    if cfg.use_features:
        sim = feature_similarity(F.col("_q_features"), F.col("cat_features"))
        x = x.withColumn("feature_sim", sim).withColumn(
            "final_boosted_score",
            F.lit(1.0 - cfg.feature_weight) * F.col("boosted_score") + F.lit(cfg.feature_weight) * F.col("feature_sim"))
    else:
        x = x.withColumn("feature_sim", F.lit(None).cast("double")).withColumn("final_boosted_score", F.col("boosted_score"))
    x = x.drop("_q_tokens", "_q_features")
    return x


def stable_order() -> list:
    """Total order equal to the reference's four successive stable sorts."""
    return [
        F.round(F.col("final_boosted_score"), 9).desc(),
        F.round(F.col("boosted_score"), 9).desc(),
        F.round(F.col("final_score"), 9).desc(),
        F.round(F.col("cross_score"), 9).desc(),
        F.col("cand_pos").asc(),
    ]


def predictions(scored: DataFrame, top_k: int = 10) -> DataFrame:
    """Long prediction records, ``rank`` 1..top_k per product."""
    t = rank.top_n(scored, top_k, stable_order())
    return t.select(
        F.col("query_id").alias("product_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("commodity_code").cast("long").alias("commodity_code"),
        "commodity_name",
        F.col("final_boosted_score").alias("score"),
        F.col("segment_name").alias("segment"),
        F.col("family_name").alias("family"),
        F.col("class_name").alias("class"),
        "in_hierarchy",
    )


def classify_batch(products: DataFrame, catalog: DataFrame, cfg: ClassifyConfig = ClassifyConfig(),
                   desc_col: str = "description", parts: Parts | None = None, **prebuilt) -> DataFrame:
    """Predictions for every product (products without candidates get no rows); ``parts`` replaces the text
    cleaner, embedder, pair model and feature extractor."""
    parts = parts or Parts(dim=cfg.embed_dim)
    cands = retrieve(products, catalog, cfg, desc_col=desc_col, parts=parts, **prebuilt)
    return predictions(score_candidates(cands, products, cfg, desc_col, parts), cfg.top_k)


def classify_lean(products: DataFrame, catalog: DataFrame, cfg: ClassifyConfig = ClassifyConfig(), **kw) -> DataFrame:
    """C4: retrieve -> rerank -> merge only."""
    lean = ClassifyConfig(**{**cfg.__dict__, "use_hierarchy": False, "use_features": False})
    return classify_batch(products, catalog, lean, **kw)


def nest(preds: DataFrame, products: DataFrame, desc_col: str = "description",
         truth_col: str | None = "commodity_name") -> DataFrame:
    """C3 nested form: one row per product with ``top_k_predictions`` sorted by rank."""
    rec = F.struct("rank", "commodity_code", "commodity_name", "score", "segment", "family", "class", "in_hierarchy")
    agg = preds.groupBy("product_id").agg(F.array_sort(F.collect_list(rec)).alias("top_k_predictions"))
    cols = [F.col("product_id"), F.col(desc_col).alias("description")]
    if truth_col:
        cols.append(F.col(truth_col).alias("ground_truth"))
    return products.select(*cols).join(shuffled(agg), "product_id", "left").select(
        "product_id", "description",
        F.coalesce("top_k_predictions", F.array().cast(agg.schema["top_k_predictions"].dataType)).alias("top_k_predictions"),
        *(["ground_truth"] if truth_col else []),
    )
