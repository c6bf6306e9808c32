"""Metrics from one read of the predictions: plan shape and a plain count."""

import random


from hiermatch.operators import evaluate as E
from hiermatch.session import shared_path


def _tables(spark, seed):
    rng = random.Random(seed)
    codes = list(range(1, 13))
    catalog = spark.createDataFrame([(c, f"s{c % 2}", f"f{c % 4}", f"c{c % 6}", f"name {c}") for c in codes],
                                    "commodity_code long, segment_name string, family_name string, class_name string, commodity_name string")
    truth = {p: rng.choice([*codes, None, 99]) for p in range(40)}
    products = spark.createDataFrame([(p, "text" if p % 9 else "", f"name {t}" if t else t) for p, t in truth.items()],
                                     "product_id long, description string, commodity_name string")
    preds = [(p, r + 1, rng.choice([*codes, 0, None, 77]), rng.choice([None, 0.1, 0.3, 0.9])) for p in truth if p % 5 for r in range(rng.randint(0, 12))]
    return truth, catalog, products, preds


def plain(truth, preds, ks, use_conf):
    out = {}
    for p, t in truth.items():
        if t is None or t == 99 or p % 9 == 0:
            continue
        mine = [x for x in preds if x[0] == p]
        kept = [x for x in mine if not use_conf or (1.0 if x[3] is None else x[3]) >= 0.3]
        best = {}
        for _, r, c, _ in kept:
            if c:
                best[c] = min(r, best.get(c, r))
        order = sorted(best, key=lambda c: (best[c], c))
        level = lambda c, m: c % m if c in range(1, 13) else None
        row = [len(mine), len(kept), len(order), order.index(t) + 1 if t in order else None]
        for k in ks:
            row += [int(any(level(c, m) == t % m for c in order[:k])) for m in (2, 4, 6)]
        out[p] = tuple(row)
    return out


def test_per_product_equals_a_plain_count(spark):
    for seed, conf in ((1, None), (2, "confidence"), (3, "confidence")):
        truth, catalog, products, preds = _tables(spark, seed)
        df = spark.createDataFrame(preds, "product_id long, rank int, commodity_code long, confidence double")
        got = E.per_product(E.gate(products, catalog), df, catalog, ks=(1, 3), conf_col=conf)
        cols = ["n_raw", "n_kept", "n_dedup", "hit_rank", *[f"{lvl}_hit_{k}" for k in (1, 3) for lvl in ("segment", "family", "class")]]
        assert {r.product_id: tuple(r[c] for c in cols) for r in got.collect()} == plain(truth, preds, (1, 3), conf is not None)


def test_metrics_scan_the_predictions_once(spark):
    _, catalog, products, preds = _tables(spark, 4)
    path = shared_path(spark, "predictions-once")
    spark.createDataFrame(preds, "product_id long, rank int, commodity_code long, confidence double").write.parquet(path)
    row = E.metrics_row(products, spark.read.parquet(path), catalog, conf_col="confidence")
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert sum("Scan parquet" in line and path.rsplit("/", 1)[-1][:20] in line for line in plan.splitlines()) == 1
    assert row.first() is not None


def test_metrics_broadcast_no_table_that_grows(spark):
    _, catalog, products, preds = _tables(spark, 5)
    path = shared_path(spark, "small-by-file")
    for name, rows in (("catalog", catalog), ("products", products), ("preds", spark.createDataFrame(
            preds, "product_id long, rank int, commodity_code long, confidence double"))):
        rows.write.parquet(f"{path}/{name}")
    catalog, products, df = (spark.read.parquet(f"{path}/{name}") for name in ("catalog", "products", "preds"))
    gated = E.gate(products, catalog)
    for rows in (gated, E.per_product(gated, df, catalog), E.error_analysis(products, df, catalog).select("product_id")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        # In the error analysis only the first missed products are few.
        assert plan.count("BroadcastHashJoin") <= ("TakeOrderedAndProject" in plan)
        assert "SortMergeJoin" in plan and rows.count() >= 0
