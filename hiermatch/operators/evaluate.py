"""Ranking and hierarchy evaluation.

Two-step aggregation: predictions are reduced per product (one shuffle on
product_id), products are *left*-joined so products without predictions add
zeros, then one global aggregate yields the metrics row.  Nothing is
collected; the metrics row is a one-row DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import join_key, name_key
from ..session import shuffled
from .position import row_position

# The cut-offs and the confidence that the results are compared at.
KS = (1, 5, 10)
THRESHOLD = 0.3
LEVELS = (("segment", "segment_name"), ("family", "family_name"), ("class", "class_name"))


def code_hierarchy(catalog: DataFrame, pos_col: str | None = None) -> DataFrame:
    """Code -> (segment, family, class, name), last row wins."""
    h = F.struct("segment_name", "family_name", "class_name", "commodity_name")
    return (
        catalog.groupBy("commodity_code")
        .agg(F.max_by(h, row_position(catalog, pos_col)).alias("h"))
        .select("commodity_code", "h.*")
    )


def name_to_code(catalog: DataFrame, pos_col: str | None = None) -> DataFrame:
    """Normalised name -> code, first row wins."""
    return (
        catalog.select(name_key("commodity_name").alias("name_key"), "commodity_code", row_position(catalog, pos_col).alias("_p"))
        .groupBy("name_key")
        .agg(F.min_by("commodity_code", "_p").alias("true_code"))
    )


def gate(products: DataFrame, catalog: DataFrame, desc_col: str = "description", truth_col: str = "commodity_name",
         pos_col: str | None = None) -> DataFrame:
    """Every product with its status ('evaluated' | 'skipped') and truth code/levels."""
    p = products.select(
        "product_id",
        F.col(desc_col).alias("description"),
        F.col(truth_col).alias("truth_name"),
        name_key(F.coalesce(F.col(truth_col), F.lit(""))).alias("name_key"),
    )
    j = p.join(shuffled(name_to_code(catalog, pos_col)), "name_key", "left")
    missing = F.col("description").isNull() | (F.col("description") == "") | (F.col("name_key") == "")
    unknown = F.col("true_code").isNull() | (F.col("true_code") == 0)
    j = j.withColumn("status", F.when(missing | unknown, F.lit("skipped")).otherwise(F.lit("evaluated")))
    h = code_hierarchy(catalog, pos_col).select(
        F.col("commodity_code").alias("true_code"),
        F.col("segment_name").alias("true_segment"),
        F.col("family_name").alias("true_family"),
        F.col("class_name").alias("true_class"),
        F.col("commodity_name").alias("true_name"),
    )
    return j.join(shuffled(h), "true_code", "left").select(
        "product_id", "description", "truth_name", "status",
        F.when(F.col("status") == "evaluated", F.col("true_code")).alias("true_code"),
        "true_segment", "true_family", "true_class", "true_name",
    )


def threshold(predictions: DataFrame, min_conf: float = THRESHOLD, conf_col: str | None = None) -> DataFrame:
    """Keep predictions whose confidence (default 1.0 when absent) reaches the threshold."""
    conf = F.coalesce(F.col(conf_col), F.lit(1.0)) if conf_col else F.lit(1.0)
    return predictions.filter(conf >= F.lit(min_conf))


def dedupe(predictions: DataFrame) -> DataFrame:
    """Drop null/0 codes, keep each code at its best rank, re-rank densely."""
    best = (
        predictions.filter(F.col("commodity_code").isNotNull() & (F.col("commodity_code") != 0))
        .groupBy("product_id", "commodity_code")
        .agg(F.min("rank").alias("orig_rank"))
    )
    w = Window.partitionBy("product_id").orderBy("orig_rank", "commodity_code")
    return best.withColumn("rank", F.row_number().over(w))


def per_product(gated: DataFrame, predictions: DataFrame, catalog: DataFrame, ks=KS, min_conf: float = THRESHOLD,
                conf_col: str | None = None, pos_col: str | None = None, match_names: bool = False) -> DataFrame:
    """Per evaluated product: counts, hit rank and per-k level matches.

    The predictions are read once: one aggregate per (product, code) counts raw and confident rows and keeps the
    best confident rank, the codes are ranked anew, and one aggregate per product does the rest.
    """
    ev = gated.filter(F.col("status") == "evaluated")
    confident = F.coalesce(F.col(conf_col), F.lit(1.0)) >= F.lit(min_conf) if conf_col else F.lit(1.0 >= min_conf)
    real = F.col("commodity_code").isNotNull() & (F.col("commodity_code") != 0)
    codes = predictions.groupBy("product_id", "commodity_code").agg(
        F.count(F.lit(1)).alias("n_raw"), F.sum(confident.cast("long")).alias("n_kept"), F.min(F.when(confident & real, F.col("rank"))).alias("best"))
    w = Window.partitionBy("product_id").orderBy(F.col("best").asc_nulls_last(), "commodity_code")
    codes = codes.withColumn("rank", F.when(F.col("best").isNotNull(), F.row_number().over(w)))
    truth = ev.select("product_id", "true_code", "true_segment", "true_family", "true_class", "truth_name")
    rows = truth.join(shuffled(codes), "product_id", "left").join(shuffled(code_hierarchy(catalog, pos_col)), "commodity_code", "left")
    hit = F.col("commodity_code") == F.col("true_code")
    if match_names:  # E13: code or lower/stripped name
        hit = hit | (join_key("commodity_name") == join_key("truth_name"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    aggs = [count("n_raw"), count("n_kept"), F.count("rank").alias("n_dedup"), F.min(F.when(hit, F.col("rank"))).alias("hit_rank")]
    for k in ks:
        for lvl, col in LEVELS:
            aggs.append(
                F.max(F.when((F.col("rank") <= k) & (F.col(col) == F.col(f"true_{lvl}")), 1).otherwise(0)).alias(
                    f"{lvl}_hit_{k}"
                )
            )
    out = rows.groupBy("product_id").agg(*aggs)
    cols = [
        "product_id", "n_raw", "n_kept", "n_dedup", "hit_rank",
        F.when(F.col("n_raw") == 0, 1).otherwise(0).alias("no_pred"),
        F.when((F.col("n_raw") > 0) & (F.col("n_kept") == 0), 1).otherwise(0).alias("all_filtered"),
        F.coalesce(1.0 / F.col("hit_rank"), F.lit(0.0)).alias("rr"),
    ]
    for k in ks:
        hk = F.coalesce((F.col("hit_rank") <= k).cast("int"), F.lit(0))
        cols += [
            hk.alias(f"hit_{k}"),
            (hk / F.lit(float(k))).alias(f"precision_{k}"),
            F.when(F.col("n_dedup") > 0, hk / F.least(F.lit(k), F.col("n_dedup")).cast("double"))
            .otherwise(0.0).alias(f"precision_kept_{k}"),
            F.when(F.col("hit_rank") <= k, 1.0 / F.log2(F.col("hit_rank") + 1.0)).otherwise(0.0).alias(f"ndcg_{k}"),
            F.when((F.col("n_kept") > 0) & (F.col("n_dedup") < k), 1).otherwise(0).alias(f"insufficient_{k}"),
        ]
        for lvl, _ in LEVELS:
            cols.append(F.coalesce(F.col(f"{lvl}_hit_{k}"), F.lit(0)).alias(f"{lvl}_hit_{k}"))
    return out.select(*cols)


def metrics_row(products: DataFrame, predictions: DataFrame, catalog: DataFrame, ks=KS, min_conf: float = THRESHOLD,
                conf_col: str | None = None, pos_col: str | None = None, desc_col: str = "description",
                truth_col: str = "commodity_name") -> DataFrame:
    """The full metrics row (percentages like the reference; 0.0 when nothing was evaluated)."""
    g = gate(products, catalog, desc_col, truth_col, pos_col)
    counts = g.agg(
        F.sum(F.when(F.col("status") == "evaluated", 1).otherwise(0)).alias("total_evaluated"),
        F.sum(F.when(F.col("status") == "skipped", 1).otherwise(0)).alias("skipped"),
    )
    pp = per_product(g, predictions, catalog, ks, min_conf, conf_col, pos_col)
    n = F.count(F.lit(1))

    def pct_mean(c):
        return F.coalesce(F.avg(c) * 100.0, F.lit(0.0))

    aggs = [
        F.sum("no_pred").alias("no_predictions"),
        F.sum("all_filtered").alias("all_filtered"),
        F.sum(F.col("n_raw") - F.col("n_kept")).alias("predictions_filtered"),
        F.coalesce(F.avg("rr"), F.lit(0.0)).alias("mrr"),
    ]
    for k in ks:
        aggs += [
            pct_mean(f"hit_{k}").alias(f"accuracy_at_{k}"),
            pct_mean(f"precision_{k}").alias(f"precision_at_{k}"),
            pct_mean(f"ndcg_{k}").alias(f"ndcg_at_{k}"),
            pct_mean(f"hit_{k}").alias(f"recall_at_{k}"),
        ]
        for lvl, _ in LEVELS:
            aggs.append(pct_mean(f"{lvl}_hit_{k}").alias(f"{lvl}_match_at_{k}"))
        aggs.append(F.sum(f"insufficient_{k}").alias(f"insufficient_at_{k}"))
    m = pp.agg(n.alias("_n"), *aggs)
    # Both sides are global aggregates (exactly one row each).
    row = counts.crossJoin(F.broadcast(m)).drop("_n")
    return row.select(
        F.coalesce("total_evaluated", F.lit(0)).cast("long").alias("total_evaluated"),
        F.coalesce("skipped", F.lit(0)).cast("long").alias("skipped"),
        F.coalesce("no_predictions", F.lit(0)).cast("long").alias("no_predictions"),
        F.coalesce("all_filtered", F.lit(0)).cast("long").alias("all_filtered"),
        F.coalesce("predictions_filtered", F.lit(0)).cast("long").alias("predictions_filtered"),
        F.lit(float(min_conf)).alias("confidence_threshold"),
        *[F.coalesce(c, F.lit(0)).cast("long" if c.startswith("insufficient") else "double").alias(c)
          for c in m.columns if c not in ("_n", "no_predictions", "all_filtered", "predictions_filtered")],
    )


def retrieval_metrics(ranked: DataFrame, truth: DataFrame, ks=KS, qid: str = "query_id", did: str = "doc_id",
                      true_col: str = "true_doc") -> DataFrame:
    """E5/E6/E8/E12 for a plain ranked list: one row of MRR, accuracy/recall/NDCG@k (fractions).

    ``truth`` holds one relevant id per query; queries without any hit count as zeros.
    """
    hits = (
        ranked.join(shuffled(truth.select(F.col(qid), F.col(true_col))), qid)
        .filter(F.col(did) == F.col(true_col))
        .groupBy(qid)
        .agg(F.min("rank").alias("hit_rank"))
    )
    per_q = truth.select(qid).distinct().join(shuffled(hits), qid, "left")
    aggs = [F.count(F.lit(1)).alias("queries"), F.coalesce(F.avg(F.coalesce(1.0 / F.col("hit_rank"), F.lit(0.0))), F.lit(0.0)).alias("mrr")]
    for k in ks:
        hk = F.coalesce((F.col("hit_rank") <= k).cast("double"), F.lit(0.0))
        aggs += [
            F.coalesce(F.avg(hk), F.lit(0.0)).alias(f"accuracy_at_{k}"),
            F.coalesce(F.avg(hk / k), F.lit(0.0)).alias(f"precision_at_{k}"),
            F.coalesce(F.avg(F.when(F.col("hit_rank") <= k, 1.0 / F.log2(F.col("hit_rank") + 1.0)).otherwise(0.0)),
                       F.lit(0.0)).alias(f"ndcg_at_{k}"),
        ]
    return per_q.agg(*aggs)


def graded_ndcg(ranked: DataFrame, grades: DataFrame, ks=KS, qid: str = "query_id", did: str = "doc_id") -> DataFrame:
    """E8 graded: (query_id, dcg_k, ndcg_k ...) with gain grade / log2(rank + 1).

    ``grades``: (query_id, doc_id, grade); documents without a grade gain nothing.  The ideal order ranks a
    query's grades downwards; queries whose grades are all zero have 0.0.
    """
    ideal_rank = F.row_number().over(Window.partitionBy(qid).orderBy(F.col("grade").desc(), F.col(did)))
    ideal = grades.withColumn("ideal_rank", ideal_rank)
    gain = lambda r, k: F.sum(F.when(F.col(r) <= k, F.col("grade") / F.log2(F.col(r) + 1.0)).otherwise(0.0))
    best = ideal.groupBy(qid).agg(*[gain("ideal_rank", k).alias(f"ideal_{k}") for k in ks])
    got = ranked.select(qid, did, "rank").join(shuffled(grades), [qid, did]).groupBy(qid).agg(*[gain("rank", k).alias(f"dcg_{k}") for k in ks])
    out = best.join(shuffled(got), qid, "left")
    cols = [F.coalesce(f"dcg_{k}", F.lit(0.0)).alias(f"dcg_{k}") for k in ks]
    cols += [F.when(F.col(f"ideal_{k}") > 0, F.coalesce(f"dcg_{k}", F.lit(0.0)) / F.col(f"ideal_{k}")).otherwise(0.0).alias(f"ndcg_{k}") for k in ks]
    return out.select(qid, *cols)


def text_label_metrics(queries: DataFrame, ranked: DataFrame, label_col: str = "commodity_name", pred_col: str = "pred_name") -> DataFrame:
    """Lean metrics; a result is relevant when its name equals the query's label text.

    ``ranked``: (query_id, rank, pred_col); queries without results count as zeros.
    """
    h = queries.select("query_id", label_col).join(shuffled(ranked.select("query_id", "rank", pred_col)), "query_id", "left").groupBy("query_id").agg(
        F.min(F.when(join_key(pred_col) == join_key(label_col), F.col("rank"))).alias("hr"))
    hk = lambda k: F.when(F.col("hr") <= k, 1.0).otherwise(0.0)
    return h.agg(F.avg(hk(1)).alias("accuracy_at_1"), F.avg(hk(5)).alias("accuracy_at_5"), F.avg(hk(10)).alias("accuracy_at_10"),
                 F.avg(hk(5) / 5).alias("precision_at_5"), F.avg(hk(5)).alias("recall_at_5"))


def level_accuracy(queries: DataFrame, ranked: DataFrame, truth: DataFrame, k: int = 5, label_col: str = "commodity_name") -> DataFrame:
    """Share of queries with a result in the first ``k`` on the true segment, family and class.

    ``truth``: (label_col, segment_name, family_name, class_name), one row per label; ``ranked`` carries the
    result's level names.
    """
    names = [col for _, col in LEVELS]
    t = truth.select(label_col, *[F.col(c).alias(f"true_{c}") for c in names])
    j = queries.select("query_id", label_col).join(shuffled(t), label_col, "left").join(shuffled(ranked.select("query_id", "rank", *names)), "query_id", "left")
    top = F.col("rank") <= k
    per = j.groupBy("query_id").agg(*[
        F.coalesce(F.max(F.when(top & (F.col(c) == F.col(f"true_{c}")), 1).otherwise(0)), F.lit(0)).alias(c) for c in names])
    return per.agg(*[F.avg(c).alias(f"{lv}_at_{k}") for lv, c in LEVELS])


def error_analysis(products: DataFrame, predictions: DataFrame, catalog: DataFrame, top_k: int = 5, max_errors: int = 20,
                   min_conf: float = THRESHOLD, conf_col: str | None = None, pos_col: str | None = None) -> DataFrame:
    """One row per (missed product, prediction): evaluated products with predictions, none of which is
    right in the first ``top_k``; the first ``max_errors`` of them by id."""
    g = gate(products, catalog, pos_col=pos_col).filter(F.col("status") == "evaluated")
    preds = threshold(predictions, min_conf, conf_col).filter(F.col("rank") <= top_k)
    judged = preds.join(shuffled(g.select("product_id", "true_code")), "product_id").groupBy("product_id").agg(
        F.max((F.col("commodity_code") == F.col("true_code")).cast("int")).alias("hit"))
    first = g.join(shuffled(judged.filter(F.coalesce("hit", F.lit(0)) == 0).select("product_id")), "product_id").orderBy("product_id").limit(max_errors)
    h = code_hierarchy(catalog, pos_col).select("commodity_code", F.col("commodity_name").alias("pred_name"), F.col("class_name").alias("pred_class"))
    conf = F.coalesce(F.col(conf_col).cast("double"), F.lit(0.0)) if conf_col else F.lit(0.0)
    rows = first.join(preds.select("product_id", "rank", "commodity_code", conf.alias("confidence")), "product_id").join(shuffled(h), "commodity_code", "left")
    return rows.select(
        "product_id", "description", "true_code", "true_name", "true_class", "true_family", "rank", F.col("commodity_code").alias("code"),
        F.coalesce("pred_name", F.lit("Unknown")).alias("name"), "confidence", F.coalesce("pred_class", F.lit("Unknown")).alias("class"))


def nest_errors(errors: DataFrame) -> DataFrame:
    """E17 nested: one row per product with ``predictions`` as array<struct<code, name, confidence, class>>."""
    rec = F.struct("rank", "code", "name", "confidence", "class")
    return errors.groupBy("product_id", "description", "true_code", "true_name", "true_class", "true_family").agg(
        F.transform(F.array_sort(F.collect_list(rec)), lambda r: F.struct(
            r["code"].alias("code"), r["name"].alias("name"), r["confidence"].alias("confidence"),
            r["class"].alias("class"))).alias("predictions"))


def display_order(ks=KS) -> list[str]:
    """The metrics in the order in which they are shown."""
    names = ["total_evaluated", "skipped", "no_predictions", "all_filtered", "predictions_filtered", "confidence_threshold", "mrr"]
    for k in ks:
        names += [f"{m}_at_{k}" for m in ("accuracy", "precision", "ndcg", "segment_match", "family_match", "class_match", "insufficient")]
    return names


def metrics_long(metrics: DataFrame, ks=KS) -> DataFrame:
    """A metrics row as (ord, metric, value) in display order."""
    names = display_order(ks)
    long = metrics.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "metric", "value")
    order = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i + 1))])
    return long.select(F.element_at(order, F.col("metric")).alias("ord"), "metric", "value")


def invariants(metrics: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """P10: what must hold between the metrics of a row, as boolean columns."""
    c = F.col
    return metrics.select(
        (c("segment_match_at_1") >= c("accuracy_at_1")).alias("segment_ge_accuracy"),
        ((c("class_match_at_5") <= c("family_match_at_5")) & (c("family_match_at_5") <= c("segment_match_at_5"))).alias("levels_nested"),
        ((c("accuracy_at_1") <= c("accuracy_at_5")) & (c("accuracy_at_5") <= c("accuracy_at_10"))).alias("accuracy_monotone"),
        (F.abs(c("precision_at_5") - c("accuracy_at_5") / 5) < tolerance).alias("precision_is_accuracy_over_k"),
        (F.abs(c("ndcg_at_1") - c("accuracy_at_1")) < tolerance).alias("ndcg1_is_accuracy1"))
