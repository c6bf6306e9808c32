"""Min-max edge cases and merge arithmetic."""

import pytest
from pyspark.sql import functions as F

from hiermatch.operators import rank


def test_minmax_all_equal_is_one(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 0.0), (2, 4.0), (2, 1.0)], "query_id int, s double")
    got = sorted((r[0], r[1]) for r in df.select("query_id", rank.minmax(F.col("s")).alias("m")).collect())
    assert got == [(1, 1.0), (1, 1.0), (2, 0.0), (2, 0.25), (2, 1.0)]


def test_merge_weights(spark):
    df = spark.createDataFrame([(1, 0.2, 0.0, 0.1), (1, 0.6, 0.2, 0.9)],
                               "query_id int, sem_score double, lex_score double, cross_score double")
    got = sorted(r["final_score"] for r in rank.merge(df).collect())
    assert got == pytest.approx([0.0, 1.0])
    got = sorted(r["final_score"] for r in rank.merge(df, 0.5, 0.5).collect())
    assert got == pytest.approx([0.0, 1.0])


def test_rerank_is_stable_on_ties(spark):
    df = spark.createDataFrame([(1, 3, 0.5), (1, 1, 0.5), (1, 2, 0.9)], "query_id int, cand_pos int, cross_score double")
    got = [r["cand_pos"] for r in rank.rerank(df, 2).orderBy("rerank_pos").collect()]
    assert got == [2, 1]


def test_minmax_ignores_the_last_bit(spark):
    from pyspark.sql import functions as F

    from hiermatch.operators import rank

    df = spark.createDataFrame([(1, 0.1 + 0.2), (1, 0.3), (2, 1.0), (2, 3.0)], "query_id long, s double")
    got = [r["m"] for r in df.select("query_id", "s", rank.minmax(F.col("s")).alias("m")).orderBy("query_id", "s").collect()]
    assert got == [1.0, 1.0, 0.0, 1.0]


def test_fuse_keeps_rows_without_text(spark):
    from hiermatch.operators import rank

    sem = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2), (1, 12, 0.7, 3)], "query_id long, doc_id long, sem_score double, sem_rank int")
    lex = spark.createDataFrame([(1, 13, 5.0, 1)], "query_id long, doc_id long, lex_score double, lex_rank int")
    cat = spark.createDataFrame([(10, None), (11, None), (12, "same"), (13, "same")], "doc_id long, corpus string")
    got = rank.fuse(sem, lex, cat).orderBy("cand_pos").collect()
    assert [(r["doc_id"], r["sem_score"], r["lex_score"]) for r in got] == [(10, 0.9, 0.0), (11, 0.8, 0.0), (12, 0.7, 5.0)]
    rows = rank.uniform_rows(rank.fuse(sem, lex, cat), ["corpus"], scores=False)
    assert rows.columns == ["query_id", "doc_id", "cand_pos", "corpus"]


def test_pluggable_pair_model(spark):
    from hiermatch.operators import rank

    df = spark.createDataFrame([(1, "ab", "abc"), (2, None, "x")], "id long, q string, d string")
    got = rank.pair_scores_with(df, "q", "d", lambda: lambda qs, ds: [len(a) + len(b) for a, b in zip(qs, ds)]).orderBy("id").collect()
    assert [r["cross_score"] for r in got] == [5.0, 1.0]


def test_fuse_of_lists_equals_fuse_and_shuffles_no_text(spark):
    from hiermatch.session import shared_path

    cat = [(10, None), (11, None), (12, "same"), (13, "same"), (14, "own"), (15, "two"), (15, "texts"), (16, "same"), (None, "lost"), (17, "last")]
    path = shared_path(spark, "fused-catalog")
    spark.createDataFrame(cat, "doc_id long, corpus string").write.parquet(path)
    cat = spark.read.parquet(path)
    sem = spark.createDataFrame([(1, [10, 11, 12, 15], [.9, .8, .7, .6], [1, 2, 3, 4]), (2, [14, 16], [.5, .4], [1, 2])],
                                "query_id long, doc_id array<long>, sem_score array<double>, sem_rank array<int>")
    lex = spark.createDataFrame([(1, [13, 15, None], [5.0, 4.0, 3.0], [1, 2, 3]), (3, [17, 12], [2.0, 1.0], [1, 2])],
                                "query_id long, doc_id array<long>, lex_score array<double>, lex_rank array<int>")
    flat = [x.select("query_id", F.inline(F.arrays_zip(*x.columns[1:]))) for x in (sem, lex)]
    same = rank.twins(cat)
    assert {r["doc_id"] for r in same.collect()} == {12, 13, 15, 16}
    fused = rank.fuse_lists(sem, lex, cat, same)
    key = lambda rows: sorted(map(str, rows))
    assert key(fused.collect()) == key(rank.fuse(*flat, cat).select(*fused.columns).collect()) and fused.count() > 8
    plan = rank.fuse_lists(sem, lex, cat, same).groupBy("query_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "corpus" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_pair_model_joins_nothing(spark):
    from hiermatch.operators.parts import Model, Parts

    parts = Parts(pair_model=Model("lengths", lambda: lambda qs, ds: [len(a) + len(b) for a, b in zip(qs, ds)]))
    cands = spark.createDataFrame([(1, 7, "ab", "abc"), (1, 8, None, "x"), (2, 7, "a", "abc"), (2, 7, "aaa", "abc")],
                                  "query_id long, doc_id long, description string, corpus string").repartition("query_id")
    scored = parts.pair_scores(cands)
    got = sorted((r["query_id"], r["doc_id"], r["description"] or "", r["cross_score"]) for r in scored.collect())
    assert got == [(1, 7, "ab", 5.0), (1, 8, "", 1.0), *[(2, 7, t, s) for t in ("a", "aaa") for s in (4.0, 6.0)]]
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()


def test_candidates_and_products_are_not_broadcast(spark):
    from hiermatch.operators import classify as C

    cands = spark.createDataFrame([(1, 7, .5, 1.0, 1, "s", ["a"], ["s"], "t")],
                                  "query_id long, doc_id long, sem_score double, lex_score double, cand_pos int, segment_name string, doc_tokens array<string>, "
                                  "reach_segments array<string>, corpus string")
    products = spark.createDataFrame([(1, "a b")], "product_id long, description string")
    scored = C.score_candidates(cands, products, C.ClassifyConfig(use_features=False))
    assert "Broadcast" not in scored._jdf.queryExecution().executedPlan().toString() and scored.count() == 1
