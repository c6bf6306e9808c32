"""Clustered exact k-NN vs numpy brute force, and the approximate form's recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiermatch.operators import vectors


def brute(q, c, k, exclude_self=False):
    out = []
    for qi, qv in q:
        d = [(float(((np.asarray(qv) - np.asarray(cv)) ** 2).sum()), ci) for ci, cv in c if not (exclude_self and ci == qi)]
        d.sort(key=lambda x: (round(x[0], 9), x[1]))
        out += [(qi, ci, dist, r + 1) for r, (dist, ci) in enumerate(d[:k])]
    return out


def test_knn_block_equals_brute_force(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    id_col, vec_col = e.columns[0], [c for c in e.columns if c != e.columns[0]][0]
    rows = [(int(r[0]), [float(x) for x in r[1]]) for r in e.select(id_col, vec_col).collect()]
    got = vectors.knn(e, e, 7, qid=id_col, cid=id_col, qvec=vec_col, cvec=vec_col, exclude_self=True,
                      query_block_rows=16, catalog_block_rows=40).collect()
    want = brute(rows, rows, 7, exclude_self=True)
    got_t = sorted((r["query_id"], r["doc_id"], r["rank"]) for r in got)
    assert got_t == sorted((a, b, r) for a, b, _, r in want)
    wd = {(a, b): d for a, b, d, _ in want}
    for r in got:
        assert r["distance"] == pytest.approx(wd[(r["query_id"], r["doc_id"])], abs=1e-6)


def test_k_larger_than_catalog(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 2.0])], "doc_id long, embedding array<double>")
    got = vectors.knn(q, c, 50).orderBy("rank").collect()
    assert [(r["doc_id"], r["distance"], r["rank"]) for r in got] == [(7, 1.0, 1), (8, 4.0, 2)]
    sim = q.select(vectors.similarity(F.lit(1.0)).alias("s"), vectors.relevance(F.lit(0.0)).alias("r")).first()
    assert sim["s"] == 0.5 and sim["r"] == 1.0


def _frame(spark, rows, name, kind="long"):
    return spark.createDataFrame(rows, f"{name} {kind}, embedding array<double>")


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e7])
def test_knn_exact_at_any_norm(spark, scale):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 8)) * scale
    c = [(i, (centre[i % 6] + rng.normal(size=8) * scale * 1e-3).tolist()) for i in range(400)]
    q = [(1000 + i, (centre[i % 6] + rng.normal(size=8) * scale * 1e-3).tolist()) for i in range(40)]
    got = vectors.knn(_frame(spark, q, "query_id"), _frame(spark, c, "doc_id"), 5, catalog_block_rows=50).collect()
    assert sorted((r["query_id"], r["doc_id"], r["rank"]) for r in got) == sorted((a, b, r) for a, b, _, r in brute(q, c, 5))


def test_knn_nulls_strings_and_ties(spark):
    zero = [0.0] * 4
    c = [(f"c{i:04d}", zero) for i in range(1000)] + [("far", [9.0] * 4), ("null", None), (None, zero)]
    q = [("q1", zero), ("q2", [9.0] * 4), ("q3", None)]
    got = vectors.knn(_frame(spark, q, "query_id", "string"), _frame(spark, c, "doc_id", "string"), 3, catalog_block_rows=64).collect()
    assert sorted((r["query_id"], r["rank"], r["doc_id"]) for r in got) == [
        ("q1", 1, "c0000"), ("q1", 2, "c0001"), ("q1", 3, "c0002"), ("q2", 1, "far"), ("q2", 2, "c0000"), ("q2", 3, "c0001")]
    assert vectors.knn(_frame(spark, q, "query_id", "string"), _frame(spark, [], "doc_id", "string"), 3).count() == 0


def test_prebuilt_index_and_text_search(spark, tmp_path):
    from hiermatch.functions.embed import hash_embed

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["red pipe", "blue valve", "red valve", "bolt"])], "doc_id long, text string")
    vectors.cluster(rows.select("doc_id", hash_embed("text").alias("embedding")), path=f"{tmp_path}/v")
    index = vectors.read_vectors(spark, f"{tmp_path}/v")
    got = vectors.search_text(spark.createDataFrame([(7, "valve blue")], "query_id long, text string"), 2, index, hash_embed).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2]


def test_lsh_recall(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    exact = {(r["query_id"], r["doc_id"]) for r in vectors.knn(e, e, 5, qid="vec_id", cid="vec_id", exclude_self=True).collect()}
    near = {(r["query_id"], r["doc_id"]) for r in vectors.knn_lsh(e, e, 5, qid="vec_id", cid="vec_id", exclude_self=True).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_pluggable_embedder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "abcd")], "id long, t string")
    got = vectors.embed_with(df, "t", "v", lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]), 2, batch_rows=2).orderBy("id").collect()
    assert [r["v"] for r in got] == [[2.0, 1.0], [0.0, 1.0], [4.0, 1.0]]


def test_a_query_travels_once_per_part_of_the_catalog(spark, monkeypatch):
    """Small blocks must not send a query's vector to every block or cluster, nor all of a batch's probes at once."""
    import pandas as pd

    rng = np.random.default_rng(5)
    c = [(i, rng.normal(size=6).tolist()) for i in range(900)]
    index = vectors.cluster(_frame(spark, c, "doc_id"), block_rows=8)
    g = vectors._Geometry(index.centres.orderBy("cluster").collect())
    assert len(g.n) > 100 and g.parts == 1
    batch = pd.DataFrame({"query_id": range(2000), "v": [rng.normal(size=6) for _ in range(2000)], "goal": np.nan})
    sizes = [(len(out), out["parts"].map(len).max()) for out in vectors._probe_fn(g, 5, True)([batch])]
    assert sum(n for n, _ in sizes) == 2000 and max(n for n, _ in sizes) <= vectors._ROW_CHUNK and max(m for _, m in sizes) == 1
    # many cells give the same rows, a large cluster in several parts included
    monkeypatch.setattr(vectors, "SHARE_ROWS", 64)
    monkeypatch.setattr(vectors, "CELL_BYTES", 64 * 6 * 8)
    c = c + [(1000 + i, [0.0] * 6) for i in range(300)]
    got = vectors.knn(_frame(spark, c, "query_id"), _frame(spark, c, "doc_id"), 4, exclude_self=True, catalog_block_rows=8).collect()
    assert sorted((r["query_id"], r["doc_id"], r["rank"]) for r in got) == sorted((a, b, r) for a, b, _, r in brute(c, c, 4, True))


def test_equal_queries_are_searched_once_and_all_answered(spark):
    """Equal vectors share one search, an id with several vectors has the nearest of all of them, as before."""
    rng = np.random.default_rng(9)
    c = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    a, b, d = ([float(x) for x in rng.normal(size=6).round(1)] for _ in range(3))
    q = [(1, a), (2, b), (3, a), (4, a), (4, b), (5, b), (5, a), (6, d), (6, d)]
    asked = vectors._asked(_frame(spark, q, "query_id").withColumnRenamed("embedding", "v"), apart=False).collect()
    assert {r["query_id"]: r["of"] for r in asked} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4, 6: 6}
    assert sum(r["vs"] is not None for r in asked) == 4
    got = vectors.knn(_frame(spark, q, "query_id"), _frame(spark, c, "doc_id"), 5).collect()
    for i in range(1, 7):
        of = [x for x in brute([v for v in q if v[0] == i], c, 300)]
        want = sorted((round(x[2], 9), x[1]) for x in of)[:5]
        mine = sorted((r["rank"], r["doc_id"]) for r in got if r["query_id"] == i)
        assert [x[1] for x in mine] == [x[1] for x in want]


def test_far_and_large_vectors_are_exact(spark):
    """Single precision only preselects: far from the origin, and beyond its range."""
    rng = np.random.default_rng(10)
    for scale, at in ((1.0, 1e6), (1e16, 0.0), (1e-9, 0.0)):
        c = [(i, (at + rng.normal(size=4) * scale).tolist()) for i in range(200)]
        q = [(1000 + i, (at + rng.normal(size=4) * scale).tolist()) for i in range(20)]
        got = vectors.knn(_frame(spark, q, "query_id"), _frame(spark, c, "doc_id"), 3, catalog_block_rows=50).collect()
        assert sorted((r["query_id"], r["doc_id"], r["rank"]) for r in got) == sorted((a, b, r) for a, b, _, r in brute(q, c, 3))
