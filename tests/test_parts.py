"""The classifier's replaceable parts: models load once per worker, defaults equal the plain form."""

import os

import pandas as pd
from pyspark.sql import functions as F

from hiermatch.functions import features as FE
from hiermatch.operators import classify as C
from hiermatch.operators import rank, vectors
from hiermatch.operators.parts import Model, Parts
from hiermatch.sources import readers, sinks
from hiermatch.sources.views import view


def test_a_model_is_loaded_once_in_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.write("x")
        return lambda texts: [[float(len(t)), float(os.getpid())] for t in texts]

    df = spark.range(400).repartition(16).select(F.col("id").cast("string").alias("text"))
    got = vectors.embed_with(df, "text", "v", Model("counted", load), 2).collect()
    assert all(r.v[0] == len(r.text) for r in got) and len(got) == 400
    files = os.listdir(folder)
    assert files and all(open(f"{folder}/{f}").read() == "x" for f in files)
    assert {str(int(r.v[1])) for r in got} <= set(files)


def test_a_model_with_the_built_in_scores_gives_the_built_in_result(spark, sf):
    """The pair model computes the token cosine itself, from texts; every prediction is the same."""
    def load():
        import re

        from hiermatch.functions.text import ABBREVIATIONS

        def words(t):
            t = t.lower()
            for a, b in ABBREVIATIONS:
                t = t.replace(a, b)
            return set(re.sub("[^a-z0-9\\s]", " ", t).split())

        def score(qs, ds):
            pairs = [(words(q), words(d)) for q, d in zip(qs, ds)]
            return [len(a & b) / (len(a) * len(b)) ** 0.5 if a and b else 0.0 for a, b in pairs]
        return score

    products, catalog = view(spark, sf, "products"), view(spark, sf, "catalog")
    cols = ["product_id", "rank", "commodity_code", F.round("score", 9).alias("score")]
    a = C.classify_batch(products, catalog).select(*cols)
    b = C.classify_batch(products, catalog, parts=Parts(pair_model=Model("cosine", load))).select(*cols)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_uniform_rows_with_and_without_scores(spark):
    cands = spark.createDataFrame([(1, 2, 1, "a", 0.5, 0.25)], "query_id long, doc_id long, cand_pos int, name string, sem_score double, lex_score double")
    assert tuple(rank.uniform_rows(cands, ["name"]).first()) == (1, 2, 1, "a", 0.5, 0.25)
    assert tuple(rank.uniform_rows(cands.drop("sem_score", "lex_score"), ["name"], scores=False).first()) == (1, 2, 1, "a", 0.0, 0.0)


def test_predictions_csv_brings_every_string_back(spark):
    texts = [None, "", " ", "  a  ", "\t", 'say "x", y', "two\nlines", "\\N", "null", '""', "\u00a0b"]
    rec = "array<struct<rank:int,commodity_code:long,commodity_name:string,score:double,segment:string,family:string,class:string,in_hierarchy:boolean>>"
    rows = [(i, t, [] if i % 2 else [(1, 7, t, 0.5, t, "f", None, True)], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"product_id long, description string, top_k_predictions {rec}, ground_truth string")
    path = sinks.scratch_path(spark, "odd-predictions")
    sinks.write_predictions_csv(df, path)
    assert sorted(map(str, readers.read_predictions_csv(spark, path).collect())) == sorted(map(str, df.collect()))


def test_texts_are_dealt_before_they_are_embedded_and_embedded_once(spark, tmp_path):
    """One unsplit file is embedded by many tasks, and no filter on the vectors embeds again."""
    seen = str(tmp_path / "seen")

    @F.pandas_udf("array<double>")
    def embed(texts: pd.Series) -> pd.Series:
        with open(seen, "a") as f:
            f.writelines("x\n" for _ in texts)
        return pd.Series([[1.0, 2.0]] * len(texts))

    docs = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "doc_id long, text string").coalesce(1)
    made = Parts().catalog(docs, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in made and "ArrowEvalPython" not in made[made.index("RepartitionByExpression"):]
    index = vectors.cluster(docs.repartition("doc_id").select("doc_id", embed("text").alias("embedding")), path=str(tmp_path / "index"))
    assert index.vectors.count() == 30
    assert len(open(seen).readlines()) == 30


def test_features_are_taken_from_the_winning_rows_only(spark):
    """The last row of a name wins, a name without positions has no features, and no other row is searched."""
    rows = [(1, "a", "5 gal ss"), (2, "a", "pvc 7 psi"), (None, "a", "brass"), (None, "b", "brass")]
    c = spark.createDataFrame(rows, "commodity_code long, commodity_name string, corpus string")
    made = C.catalog_features(c)
    got = {r["commodity_name"]: r["cat_features"] for r in made.collect()}
    assert got["b"] is None
    want = c.where("commodity_code = 2").select(FE.feature_vector("corpus")).first()[0]
    assert got["a"] == want == c.where("commodity_code = 2").select(F.array(*FE.feature_columns("corpus"))).first()[0]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in plan and "regexp_extract" not in plan[plan.index("Aggregate"):]
