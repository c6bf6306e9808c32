"""A lexical index in immutable segments (R1): new documents are added as a segment, nothing is written again.

A segment holds postings (token, slot, doc_id, dl, tf), bucketed by (token, slot); a slot is a hash range of a token's
documents of about SLOT_ROWS postings, so a token that is in all documents lies in many buckets, and one document's
posting is found by its slot.  Queries are brought to the buckets; the index side is read without an exchange.

Statistics merge: a segment keeps N, the total length and per token df and the ranges of tf and dl, and idf and weights
are applied at query time from the sums over all segments.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_token_list
from .lexical import B, EPSILON, K1, _kept, postings, pruned_topk, query_terms

#: Postings that a slot holds on average.
SLOT_ROWS = 256


@dataclass
class Segments:
    postings: list[DataFrame]  # per segment: token, slot, doc_id, dl, tf; bucketed by (token, slot)
    terms: list[DataFrame]  # per segment: token, df, slots, tf_min, tf_max, dl_min, dl_max
    n_docs: int
    total: int  # tokens of all documents

    @property
    def avgdl(self) -> float:
        return self.total / self.n_docs if self.total else 1.0


def _slot(doc_id, slots) -> Column:
    return F.pmod(F.xxhash64(doc_id), slots).cast("long")


def add_segment(docs: DataFrame, id_col: str, text_col: str, path: str, tokenizer=clean_token_list, buckets: int | None = None) -> None:
    """Write ``docs`` as one more segment of the index below ``path``; ids must be new to it.

    The segment counts once its line in the manifest is written, which is the last step, so an index whose writer
    died is as before.
    """
    spark = docs.sparkSession
    name = uuid.uuid4().hex
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = f"{path}/segments/{name}/raw"
    postings(docs, id_col, text_col, tokenizer).write.parquet(raw)
    post = spark.read.parquet(raw)
    bounds = [f(c).alias(f"{c}_{f.__name__}") for c in ("tf", "dl") for f in (F.min, F.max)]
    terms = post.groupBy("token").agg(F.count(F.lit(1)).alias("df"), *bounds)
    terms = terms.withColumn("slots", F.floor((F.col("df") + F.lit(SLOT_ROWS - 1)) / F.lit(SLOT_ROWS)).cast("long"))
    terms.write.parquet(f"{path}/segments/{name}/terms")
    placed = post.join(spark.read.parquet(f"{path}/segments/{name}/terms").select("token", "slots"), "token")
    placed = placed.select("token", _slot("doc_id", F.col("slots")).alias("slot"), "doc_id", "dl", "tf")
    (placed.repartition(buckets, "token", "slot").write.bucketBy(buckets, "token", "slot").sortBy("token", "slot")
     .option("path", f"{path}/segments/{name}/postings").saveAsTable(f"hiermatch_postings_{name}"))
    size = docs.agg(F.count(F.lit(1)).alias("n_docs")).crossJoin(F.broadcast(post.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("total"))))
    id_type = post.schema["doc_id"].dataType.simpleString()
    size.select(F.lit(name).alias("name"), F.lit(buckets).alias("buckets"), F.lit(id_type).alias("id_type"), "n_docs", "total").write.mode("append").parquet(f"{path}/manifest")


def open_segments(spark: SparkSession, path: str) -> Segments:
    """The index below ``path``, in any session: postings are known as bucketed tables to this one from here on."""
    found = spark.read.parquet(f"{path}/manifest").orderBy("name").collect()  # one row per segment
    tables = []
    for s in found:
        table = f"hiermatch_postings_{s.name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (token STRING, slot BIGINT, doc_id {s.id_type}, dl INT, tf BIGINT) USING parquet "
                  f"CLUSTERED BY (token, slot) SORTED BY (token, slot) INTO {s.buckets} BUCKETS LOCATION '{path}/segments/{s.name}/postings'")
        tables.append(spark.table(table))
    terms = [spark.read.parquet(f"{path}/segments/{s.name}/terms") for s in found]
    return Segments(tables, terms, sum(s.n_docs for s in found), sum(s.total for s in found))


def _weight(idf, tf, dl, avgdl: float) -> Column:
    tf = tf.cast("double")
    return idf * tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * dl / F.lit(avgdl)))


def merged_terms(index: Segments) -> DataFrame:
    """(token, df, idf, w_min, w_max) over all segments; the bounds hold for every posting."""
    every = index.terms[0]
    for t in index.terms[1:]:
        every = every.unionByName(t)
    df = every.groupBy("token").agg(F.sum("df").alias("df"), *(f(c).alias(c) for f, c in ((F.min, "tf_min"), (F.max, "tf_max"), (F.min, "dl_min"), (F.max, "dl_max"))))
    raw = F.log(F.lit(index.n_docs) - F.col("df") + F.lit(0.5)) - F.log(F.col("df") + F.lit(0.5))
    df = df.withColumn("raw", raw)
    mean = df.agg(F.coalesce(F.avg("raw"), F.lit(0.0)).alias("mean"))
    idf = F.when(F.col("raw") < 0, F.lit(EPSILON) * F.col("mean")).otherwise(F.col("raw"))
    df = df.crossJoin(F.broadcast(mean)).withColumn("idf", idf)
    low, high = (_weight(F.col("idf"), F.col(f"tf_{a}"), F.col(f"dl_{b}"), index.avgdl) for a, b in (("min", "max"), ("max", "min")))
    return df.select("token", "df", "idf", F.least(low, high).alias("w_min"), F.greatest(low, high).alias("w_max"))


def bm25_topk_segments(queries: DataFrame, qid_col: str, text_col: str, index: Segments, k: int, tokenizer=clean_token_list) -> DataFrame:
    """R2 + R3: (query_id, doc_id, score, rank); the same rows as :func:`lexical.bm25_topk` over one index of all documents."""
    terms = query_terms(queries, qid_col, text_col, tokenizer).join(merged_terms(index), "token").select(
        "query_id", "token", "qtf", "df", "idf", F.greatest(F.col("qtf") * F.col("w_max"), F.lit(0.0)).alias("most"))
    terms = _kept(terms, "lexical-terms")
    part = F.col("qtf") * _weight(F.col("idf"), F.col("tf"), F.col("dl"), index.avgdl)

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def summed(chosen: DataFrame) -> DataFrame:
        hits = []
        for post, own in zip(index.postings, index.terms):
            there = chosen.join(own.select("token", "slots"), "token").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
            hits.append(there.join(post, ["token", "slot"]).select("query_id", "doc_id", part.alias("part")))
        return union(hits).groupBy("query_id", "doc_id").agg(F.sum("part").alias("part"))

    def looked_up(pairs: DataFrame) -> DataFrame:
        hits = []
        for post, own in zip(index.postings, index.terms):
            there = pairs.withColumnRenamed("doc_id", "wanted").join(own.select("token", "slots"), "token").withColumn("slot", _slot("wanted", F.col("slots")))
            # Inside a slot ids are compared one by one: as a third join key they would cost the index side an exchange.
            same = F.array_contains(F.array("doc_id"), F.col("wanted"))
            hits.append(there.join(post, ["token", "slot"]).where(same).select("query_id", "doc_id", part.alias("part")))
        return union(hits)

    return pruned_topk(terms, k, summed, looked_up)
