"""The index in segments: same rows as one index of all documents, hot tokens over buckets, no exchange of the index."""

import random
import re

import pytest

from hiermatch.operators import lexical, segments
from hiermatch.session import shared_path

from test_lexical import plain_topk


def _build(spark, parts, schema="doc_id string, text string"):
    path = shared_path(spark, "segments")
    for docs in parts:
        segments.add_segment(spark.createDataFrame(docs, schema), "doc_id", "text", path, lexical.split_tokens, buckets=5)
    return path


def _docs(rng, n):
    rare = [f"r{i}" for i in range(60)]
    common = ["brand", "the", "of", "steel"]
    docs = [(f"d{i:04d}", " ".join([c for c in common if rng.random() < 0.95] + rng.choices(rare, k=rng.randint(0, 4)))) for i in range(n)]
    queries = [(f"q{i}", " ".join(rng.choices(rare, k=rng.randint(0, 3)) + rng.choices(common, k=rng.randint(1, 4)) + ["nowhere"])) for i in range(25)]
    return docs, queries


@pytest.mark.parametrize("k,slot_rows", [(3, 256), (10, 7)])
def test_segments_equal_one_index(spark, monkeypatch, k, slot_rows):
    monkeypatch.setattr(segments, "SLOT_ROWS", slot_rows)
    docs, queries = _docs(random.Random(k), 300)
    docs += [("z1", ""), ("z2", None)]
    qs = spark.createDataFrame(queries, "qid string, text string")
    want = plain_topk([(d, t or "") for d, t in docs], queries, k)
    for parts in ([docs], [docs[:1], docs[1:250], docs[250:]]):
        index = segments.open_segments(spark, _build(spark, parts))
        got = segments.bm25_topk_segments(qs, "qid", "text", index, k, lexical.split_tokens).collect()
        assert {(r.query_id, r.doc_id, r["rank"]) for r in got} == want
    one = lexical.build_index(spark.createDataFrame(docs, "doc_id string, text string"), "doc_id", "text", lexical.split_tokens)
    both = {r.token: (r.df, round(r.idf, 9)) for r in segments.merged_terms(index).collect()}
    assert both == {r.token: (r.df, round(r.idf, 9)) for r in one.idf.collect()}
    assert index.n_docs == 302 and round(index.avgdl, 9) == round(one.stats.first().avgdl, 9)


def test_a_token_of_all_documents_lies_in_many_buckets(spark):
    path = _build(spark, [[(i, "every word " + str(i)) for i in range(4000)]], "doc_id long, text string")
    index = segments.open_segments(spark, path)
    per_file = index.postings[0].where("token = 'every'").selectExpr("input_file_name() as f").groupBy("f").count().collect()
    assert len(per_file) == 5 and max(r["count"] for r in per_file) < 2000
    top = segments.bm25_topk_segments(spark.createDataFrame([(1, "every 3999")], "q long, text string"), "q", "text", index, 2, lexical.split_tokens)
    assert [r.doc_id for r in top.orderBy("rank").collect()] == [3999, 0]


def test_an_index_is_opened_anew_and_a_dead_writer_leaves_it_as_it_was(spark):
    docs, queries = _docs(random.Random(8), 80)
    path = _build(spark, [docs])
    index = segments.open_segments(spark, path)
    for r in spark.catalog.listTables():
        if r.name.startswith("hiermatch_postings_"):
            spark.sql(f"DROP TABLE {r.name}")  # external: the files stay
    spark.createDataFrame([("t", "x")], "doc_id string, text string").write.parquet(f"{path}/segments/half/raw")
    again = segments.open_segments(spark, path)
    assert again.n_docs == index.n_docs and again.postings[0].count() > 0


def test_the_index_side_has_no_exchange(spark):
    docs, queries = _docs(random.Random(9), 200)
    index = segments.open_segments(spark, _build(spark, [docs[:100], docs[100:]]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        top = segments.bm25_topk_segments(spark.createDataFrame(queries, "qid string, text string"), "qid", "text", index, 5, lexical.split_tokens)
        lines = top._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = [re.search(r"[A-Za-z]", x).start() if re.search(r"[A-Za-z]", x) else 0 for x in lines]
    scans = [i for i, x in enumerate(lines) if "Scan parquet" in x and "hiermatch_postings_" in x]
    assert len(scans) >= 6
    for i in scans:
        at, i = depth[i], i - 1
        while "Join" not in lines[i]:
            if depth[i] < at:  # an ancestor
                assert "Exchange" not in lines[i], lines[i]
                at = depth[i]
            i -= 1
