"""The registered queries over the small tables, and the pipeline against its operators' brute-force forms."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from hiermatch.llm import pii, queries
from hiermatch.llm.common import save, table

from .test_ops import plain_components, plain_lines, plain_print, plain_secrets, plain_shingles, plain_substring


@pytest.fixture(scope="module")
def documents(sf):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cur = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, cur.fetchall()))


def test_simhash_query(spark, sf, documents):
    comp = plain_components([i for i, _ in documents], [plain_print(t) for _, t in documents], 3)
    got = {(r.doc_id, r.component_id) for r in queries.QUERIES["op1_simhash"](spark, sf).collect()}
    assert got == {(documents[n][0], c) for n, c in comp.items()}


def test_span_queries(spark, sf, documents):
    texts = dict(documents)
    sha = lambda xs: hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in xs).encode()).hexdigest()
    for r in queries.QUERIES["op7_secrets"](spark, sf).collect():
        base = plain_secrets(texts[r.doc_id])
        assert r.base_sha256 == sha(base) and {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))
    for r in queries.QUERIES["op6_pii"](spark, sf).collect():
        t, base = texts[r.doc_id], []
        base += [("email", *m.span()) for m in pii.EMAIL.finditer(t)]
        base += [("ip", *m.span()) for m in pii.IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        base += [("card", *m.span()) for m in pii.CARD.finditer(t) if 13 <= len(re.findall("[0-9]", m[0])) <= 19 and pii.luhn(re.sub("[^0-9]", "", m[0]))]
        base += [("phone", *m.span()) for m in pii.PHONE.finditer(t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
        assert r.base_sha256 == sha(base) and {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))


def test_quality_query(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    got = [r for r in queries.QUERIES["op9_quality"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert got and sum(r.predicted == labels[r.doc_id] for r in got) / len(got) >= 0.8


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents")
    cols, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = save(stage(spark, docs, sf), "test-stage")
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == cols and {tuple(r) for r in seen[name][1]} <= {tuple(r) for r in before}
    kept = lambda name: {r.doc_id for r in seen[name][1]}

    groups = defaultdict(list)
    for r in seen["exact_dedup"][0]:
        groups[r.text].append(r.doc_id)
    assert kept("exact_dedup") == {min(g) for g in groups.values()}

    before = seen["simhash_dedup"][0]
    comp = plain_components([r.doc_id for r in before], [plain_print(r.text) for r in before], 3)
    assert kept("simhash_dedup") == set(comp.values())

    items = [plain_shingles(r["text"], 5) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    def dirty(text):
        own = {k: plain_shingles_of(text, k) for k in {k for k, _ in items if k}}
        return any(k and len(s & own[k]) >= 0.8 * len(s) - 1e-9 for k, s in items)
    assert kept("decontamination") == {r.doc_id for r in seen["decontamination"][0] if not dirty(r.text)}

    assert kept("packing") == kept("decontamination") and len(seen["packing"][1]) == len(kept("packing"))
    whole = corpus_pipeline.run(spark, sf)
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in seen["packing"][1]}


def plain_shingles_of(text, k):
    ws = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)}


def test_text_queries_brute_force(spark, sf, documents):
    assert {tuple(r) for r in queries.QUERIES["op5_substring"](spark, sf).collect()} == set(plain_substring(documents, 13))
    assert {tuple(r) for r in queries.QUERIES["op10_lines"](spark, sf).collect()} == set(plain_lines(documents, 3))


@pytest.mark.parametrize("rows", [0, 40])
def test_whole_pipeline_on_odd_tables(spark, sf, tmp_path, rows):
    """No rows; and null ids, repeated ids and rows, null texts, and columns with the names the operators use."""
    path, docs = str(tmp_path), table(spark, sf, "documents")
    docs = docs.limit(rows).unionByName(docs.limit(rows // 4).withColumn("doc_id", docs["doc_id"] * 0 if rows else docs["doc_id"]))
    odd = docs.limit(rows // 8).selectExpr("cast(null as bigint) as doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    docs = docs.unionByName(odd).unionByName(odd.withColumn("text", odd["text"].substr(0, 0))).unionByName(odd.selectExpr(
        "doc_id", "cast(null as string) as text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    for c in ("digest", "fp", "hot", "salt", "bucket", "stats", "length", "score", "label", "id", "key", "rest", "bad_id", "gone_id", "component_id"):
        docs = docs.selectExpr("*", f"'x' as {c}")
    docs.write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark"):
        table(spark, sf, t).write.parquet(f"{path}/{t}.parquet")
    now, texts = spark.read.parquet(f"{path}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = save(stage(spark, now, path), "test-odd")
        assert after.columns == now.columns
        texts, now = {r.text for r in after.collect()}, after
        assert name != "exact_dedup" or now.count() == len({t or "" for t in texts})
    assert corpus_pipeline.run(spark, path).count() == now.count()
