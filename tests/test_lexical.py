"""BM25 (R1-R3): the pruned top-k against the formula."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hiermatch.operators import grouped, lexical

DOCS = [
    (1, "steel pipe steel"),
    (2, "steel valve"),
    (3, "copper pipe fitting"),
    (4, "steel bolt"),
    (5, "brass valve body"),
]
QUERIES = [(10, "steel pipe"), (11, "valve"), (12, "unknown words"), (13, "pipe pipe fitting")]


def py_bm25(docs, queries, k1=1.5, b=0.75, eps=0.25):
    toks = {d: t.split() for d, t in docs}
    n = len(docs)
    avgdl = sum(len(t) for t in toks.values()) / n
    df = Counter(t for ts in toks.values() for t in set(ts))
    raw = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {t: (eps * mean if v < 0 else v) for t, v in raw.items()}
    out = {}
    for q, text in queries:
        for d, ts in toks.items():
            tf = Counter(ts)
            shared = [t for t in text.split() if t in tf]
            if not shared:
                continue
            s = sum(idf[t] * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(ts) / avgdl)) for t in text.split() if t in tf)
            out[(q, d)] = s
    return out


def test_bm25_matches_formula(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    qs = spark.createDataFrame(QUERIES, "qid long, text string")
    idx = lexical.build_index(docs, "doc_id", "text", tokenizer=lexical.split_tokens)
    got = lexical.bm25_topk(qs, "qid", "text", idx, k=10, tokenizer=lexical.split_tokens).collect()
    want = py_bm25(DOCS, QUERIES)
    assert {(r["query_id"], r["doc_id"]) for r in got} == set(want)
    for r in got:
        assert r["score"] == pytest.approx(want[(r["query_id"], r["doc_id"])], abs=1e-9)
    # ranks: score desc, doc id asc, 1..n per query
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append(r)
    for q, rs in by_q.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, len(rs) + 1))
        keys = [(-round(r["score"], 9), r["doc_id"]) for r in rs]
        assert keys == sorted(keys)


def test_negative_idf_floor(spark):
    # 'steel' is in 3 of 5 docs: raw idf ln(2.5) - ln(3.5) < 0, floored to eps * mean idf.
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    idx = lexical.build_index(docs, "doc_id", "text", tokenizer=lexical.split_tokens)
    mean = idx.stats.first()["mean_idf"]
    row = idx.idf.filter(F.col("token") == "steel").first()
    assert row["df"] == 3
    assert row["idf"] == pytest.approx(0.25 * mean)
    assert mean > 0


def plain_topk(docs, queries, k):
    by = {}
    for (q, d), s in py_bm25(docs, queries).items():
        by.setdefault(q, []).append((-round(s, 9), d))
    return {(q, d, n + 1) for q, rows in by.items() for n, (_, d) in enumerate(sorted(rows)[:k])}


@pytest.mark.parametrize("k", [1, 3, 10, 1000])
def test_topk_prunes_exactly(spark, k):
    """Hot tokens in nearly every document, string ids, repeated query tokens, few and many results."""
    rng = random.Random(k)
    rare = [f"r{i}" for i in range(60)]
    common = ["brand", "the", "of", "steel"]
    docs = [(f"d{i:03d}", " ".join([c for c in common if rng.random() < 0.95] + rng.choices(rare, k=rng.randint(0, 4)))) for i in range(300)]
    queries = [(f"q{i}", " ".join(rng.choices(rare, k=rng.randint(0, 3)) + rng.choices(common, k=rng.randint(1, 4)))) for i in range(30)]
    idx = lexical.build_index(spark.createDataFrame(docs, "doc_id string, text string"), "doc_id", "text", tokenizer=lexical.split_tokens)
    qs = spark.createDataFrame(queries, "qid string, text string")
    for index in (idx, lexical.store_index(idx)):
        got = lexical.bm25_topk(qs, "qid", "text", index, k, tokenizer=lexical.split_tokens).collect()
        assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got} == plain_topk(docs, queries, k)


def test_topk_with_negative_weights(spark):
    # Every token is in most documents, so the mean idf and with it the floored idf are negative.
    docs = [(i, "a b c" if i % 5 else "a b") for i in range(20)]
    queries = [(1, "a b c"), (2, "c c"), (3, "a")]
    idx = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", tokenizer=lexical.split_tokens)
    got = lexical.bm25_topk(spark.createDataFrame(queries, "qid long, text string"), "qid", "text", idx, 4, tokenizer=lexical.split_tokens).collect()
    assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got} == plain_topk(docs, queries, 4)


@pytest.mark.parametrize("groups,k", [(1, 7), (20, 1), (20, 7), (10_000, 1000)])
def test_grouped_topk_is_exact(spark, groups, k):
    """Few, some and as many groups as documents; hot tokens, ties, string ids, repeated and unknown query tokens."""
    rng = random.Random(k + groups)
    rare = [f"r{i}" for i in range(60)]
    common = ["brand", "the", "of", "steel", "big", "red", "blue"]
    docs = [(f"d{i:03d}", " ".join([c for c in common if rng.random() < 0.6] + rng.choices(rare, k=rng.randint(0, 3)))) for i in range(300)]
    docs += [("e1", ""), ("e2", None)]
    queries = [(f"q{i}", " ".join(rng.choices(rare, k=rng.randint(0, 3)) + rng.choices(common, k=rng.randint(0, 4)) + ["nowhere"])) for i in range(30)]
    idx = lexical.build_index(spark.createDataFrame(docs, "doc_id string, text string"), "doc_id", "text", tokenizer=lexical.split_tokens)
    got = grouped.bm25_topk_grouped(spark.createDataFrame(queries, "qid string, text string"), "qid", "text", grouped.group_index(idx, groups=groups), k,
                                    tokenizer=lexical.split_tokens).collect()
    assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got} == plain_topk([(d, t or "") for d, t in docs], queries, k)


def test_grouped_topk_with_negative_weights(spark):
    docs = [(i, "a b c" if i % 5 else "a b") for i in range(20)]
    queries = [(1, "a b c"), (2, "c c"), (3, "a")]
    idx = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", tokenizer=lexical.split_tokens)
    got = grouped.bm25_topk_grouped(spark.createDataFrame(queries, "qid long, text string"), "qid", "text", grouped.group_index(idx), 4, tokenizer=lexical.split_tokens).collect()
    assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got} == plain_topk(docs, queries, 4)


def test_grouped_topk_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert grouped.bm25_topk_grouped(some, "doc_id", "text", grouped.group_index(lexical.build_index(none, "doc_id", "text")), 3).count() == 0
    assert grouped.bm25_topk_grouped(none, "doc_id", "text", grouped.group_index(lexical.build_index(some, "doc_id", "text")), 3).count() == 0


def test_grouped_scores_fewer_pairs_as_the_catalog_grows(spark):
    """Pairs that are scored, as a share of queries x rows: it falls, and the rows equal the pruned plan's."""
    from hiermatch.operators import classify as C
    from hiermatch.sources.views import view

    shares = []
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        c, q = C.with_corpus(view(spark, sf, "catalog")), view(spark, sf, "products")
        idx = lexical.build_stored_index(c, "commodity_code", "corpus")
        g = grouped.group_index(idx)
        shares.append(grouped.candidates(q, "product_id", "description", g, 20).count() / (c.count() * q.count()))
    assert shares[1] < 0.7 * shares[0]
    few = q.where("product_id % 50 = 0")
    cols = ["query_id", "doc_id", F.round("score", 6).alias("s"), "rank"]
    a = lexical.bm25_topk(few, "product_id", "description", idx, 20).select(*cols)
    b = grouped.bm25_topk_grouped(few, "product_id", "description", g, 20).select(*cols)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_grouped_plan_has_no_python_and_no_pairs(spark, sf):
    from hiermatch.operators import classify as C
    from hiermatch.sources.views import view

    idx = grouped.group_index(lexical.build_index(C.with_corpus(view(spark, sf, "catalog")), "commodity_code", "corpus"))
    plan = grouped.bm25_topk_grouped(view(spark, sf, "products"), "product_id", "description", idx, 20)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_topk_plan_has_no_python_and_no_pairs(spark, sf):
    from hiermatch.operators import classify as C
    from hiermatch.sources.views import view

    idx = lexical.build_index(C.with_corpus(view(spark, sf, "catalog")), "commodity_code", "corpus")
    plan = lexical.bm25_topk(view(spark, sf, "products"), "product_id", "description", idx, 20)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def test_odd_blanks_split(spark):
    df = spark.createDataFrame([("a\u00a0b\u3000c\td",)], "t string")
    assert df.select(lexical.split_tokens("t")).first()[0] == ["a", "b", "c", "d"]


@pytest.mark.parametrize("k", [1, 5, 40])
def test_dense_topk_over_classes_is_exact(spark, monkeypatch, k):
    """Copies are scored once, ties go by id over classes, and a class travels once per bounded block of the other side."""
    import random

    rnd = random.Random(4)
    words = [f"w{i}" for i in range(9)]
    docs = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=rnd.randint(0, 4)))) for i in range(500)] + [(700, None)], "doc_id long, text string")
    asked = [(i, " ".join(rnd.choices(words + ["zz"], k=rnd.randint(0, 4)))) for i in range(200)] + [(None, "w1 w2"), (900, "w1 w2"), (900, "w3")]
    queries = spark.createDataFrame(asked, "query_id long, text string")
    index = lexical.build_stored_index(docs, "doc_id", "text")
    known = lambda t: sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 8)) for r in t.collect() if r["query_id"] is not None)
    want = known(lexical.bm25_topk(queries, "query_id", "text", index, k))
    for shares in (4096, 20):
        monkeypatch.setattr(lexical, "SHARE_ROWS", shares)
        got = lexical.bm25_topk_dense(queries, "query_id", "text", index, k, query_block=7, doc_block=9)
        assert known(got) == want
        assert [(r["rank"], r["doc_id"]) for r in got.where("query_id is null").orderBy("rank").collect()] == \
            [(r["rank"], r["doc_id"]) for r in got.where("query_id = 7").limit(0).collect()] + [
                (r["rank"], r["doc_id"]) for r in lexical.bm25_topk(queries.where("query_id is null").select(F.lit(5).alias("query_id"), "text"), "query_id", "text", index, k).orderBy("rank").collect()]
    rows = index.weights.select(F.explode(F.sequence(F.lit(1), F.lit(40))).alias("copy"), "doc_id", "token", "w").select((F.col("copy") * 1000 + F.col("doc_id")).alias("doc_id"), "token", "w")
    from hiermatch.session import shared_path
    found = lexical._classes(rows, "doc_id", "w", shared_path(spark, "classes"))
    assert found.count() > 15_000 and found.select("a", "b").distinct().count() < 500


def test_texts_are_dealt_by_id_and_tokenised_once(spark):
    """One file is tokenised by many tasks, only texts are shuffled, and no filter below the exchange tokenises again."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    for made, key in ((lexical.postings(docs, "doc_id", "text"), "doc_id"), (lexical.query_terms(docs, "doc_id", "text"), "query_id")):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("RepartitionByExpression"):]
        assert "RepartitionByExpression [" + key in plan and plan.count("split(") == 1 and "split(" not in below
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_seeds_are_scored_in_full(spark):
    """The goal counts all tokens of the seeds, so documents with a few common words only are no candidates."""
    words = [f"m{i}" for i in range(8)]
    docs = [(i, "rare " + " ".join(words)) for i in range(5)] + [(100 + i, f"{words[i % 8]} " + " ".join(f"x{i}_{j}" for j in range(8))) for i in range(400)]
    idx = lexical.store_index(lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", tokenizer=lexical.split_tokens))
    asked = [(1, "rare " + " ".join(words))]
    queries = spark.createDataFrame(asked, "qid long, text string")
    looked, whole = [], lexical.pruned_topk

    def spied(terms, k, summed, looked_up):
        return whole(terms, k, summed, lambda pairs: looked.append(pairs) or looked_up(pairs))

    lexical.pruned_topk = spied
    try:
        got = lexical.bm25_topk(queries, "qid", "text", idx, 5, tokenizer=lexical.split_tokens).collect()
    finally:
        lexical.pruned_topk = whole
    assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got} == plain_topk(docs, asked, 5)
    assert looked[-1].select("doc_id").distinct().count() == 5


def test_forward_index_gives_the_rows_of_the_postings(spark, monkeypatch):
    """Repeated and null ids, documents without words and blocks on both sides."""
    import random

    rnd = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    rows = [(i % 130, " ".join(rnd.choices(words, k=rnd.randint(0, 5)))) for i in range(150)] + [(None, "w1 w2"), (None, "w2"), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    queries = spark.createDataFrame([(i, " ".join(rnd.choices(words + [f"own{i}"], k=4))) for i in range(60)] + [(90, "zz"), (91, None)], "query_id long, text string")
    stored, forward = lexical.build_stored_index(docs, "doc_id", "text"), lexical.build_forward_index(docs, "doc_id", "text")
    for name, value in (("SHARE_ROWS", 5), ("CELL_DOCS", 20), ("CELL_ROWS", 9)):
        monkeypatch.setattr(lexical, name, value)
    known = lambda t: sorted((r["query_id"], r["rank"], r["doc_id"] is None, r["doc_id"] or 0, round(r["score"], 8)) for r in t.collect())
    got = [known(lexical.bm25_topk_dense(queries, "query_id", "text", index, 4)) for index in (stored, forward)]
    assert got[0] == got[1] and len(got[0]) > 100


def test_words_that_no_document_has_make_no_class(spark, monkeypatch):
    """Queries that differ in such words only are one class, and travel and score once."""
    docs = spark.createDataFrame([(i, f"red w{i % 4}") for i in range(40)], "doc_id long, text string")
    queries = spark.createDataFrame([(i, f"red w{i % 4} own{i}") for i in range(80)], "query_id long, text string")
    written, whole = [], lexical._classes
    monkeypatch.setattr(lexical, "_classes", lambda *a: written.append(whole(*a)) or written[-1])
    top = lexical.bm25_topk_dense(queries, "query_id", "text", lexical.build_forward_index(docs, "doc_id", "text"), 3)
    assert top.count() == 240
    assert [t.select("a", "b").distinct().count() for t in written] == [4, 4]


def test_forward_index_shuffles_no_postings(spark, tmp_path):
    """Texts and document frequencies are shuffled, not one row per posting."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    index = lexical.build_forward_index(docs, "doc_id", "text", path=str(tmp_path / "index"))
    vocabulary = index.idf.select("token", "idf").withColumn("code", F.lit(1).cast("long"))
    plan = index.weighed(F.broadcast(vocabulary))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert index.documents.count() == index.documents.select("doc_id").distinct().count()
