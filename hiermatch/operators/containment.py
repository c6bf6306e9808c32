"""Exact "document contains passage" join without pairing every passage with every document.

A passage that occurs verbatim in a document contains its *interior* tokens
(all but the first and last, which may be cut mid-word) as whole tokens of
that document.  So: pick each passage's rarest interior token, equi-join it
with the document token index, and verify ``contains`` on the survivors.
Passages too short to own an interior token (at most two words) are a stated
query set: they go against all documents in blocks of a checked size, and a
document is read once per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_WORD_SPLIT = r"[^\p{L}\p{N}]+"
MAX_SHORT_PASSAGE_BYTES = 64 << 20


def raw_tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.coalesce(col, F.lit("")), _WORD_SPLIT), lambda t: t != "")


def contains_join(passages: DataFrame, docs: DataFrame, pid: str = "item_id", ptext: str = "text",
                  did: str = "doc_id", dtext: str = "text",
                  max_broadcast_bytes: int = MAX_SHORT_PASSAGE_BYTES) -> DataFrame:
    """All (passage id, doc id) with ``contains(doc text, passage text)``."""
    p = passages.select(F.col(pid).alias("pid"), F.col(ptext).alias("ptext")).filter(F.col("ptext").isNotNull())
    d = docs.select(F.col(did).alias("did"), F.col(dtext).alias("dtext")).filter(F.col("dtext").isNotNull())

    # Interior tokens of each passage: tokens of the text strictly inside the first and last separator.
    inner_text = F.regexp_extract(F.col("ptext"), r"(?s)^[\p{L}\p{N}]*[^\p{L}\p{N}]+(.*?)[^\p{L}\p{N}]+[\p{L}\p{N}]*$", 1)
    pt = p.select("pid", F.explode(F.array_distinct(raw_tokens(inner_text))).alias("token"))
    doc_tokens = d.select("did", F.explode(F.array_distinct(raw_tokens("dtext"))).alias("token"))
    # Only the passages' tokens are looked up, so the documents' rows shrink before they are counted.
    doc_tokens = cut_lineage(doc_tokens.join(pt.select("token").distinct(), "token", "left_semi"))
    dfreq = doc_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy("pid").orderBy(F.col("df").asc(), F.col("token").asc())
    anchor = (
        pt.join(dfreq, "token").withColumn("r", F.row_number().over(w)).filter("r = 1").select("pid", "token")
    )
    via_token = (
        anchor.join(doc_tokens, "token")
        .join(p, "pid")
        .join(d, "did")
        .filter(F.col("dtext").contains(F.col("ptext")))
        .select("pid", "did")
    )
    # Passages with an interior token that no document has cannot be contained anywhere;
    # passages without interior tokens fall back to a checked-size broadcast scan.
    short = p.join(pt.select("pid").distinct(), "pid", "left_anti")
    size = short.agg(F.coalesce(F.sum(F.octet_length("ptext") + 16), F.lit(0))).first()[0]
    # Beyond the bound the short passages are hashed into chunks that each fit it; every chunk
    # is one broadcast scan of the documents, so no broadcast ever exceeds the checked size.
    chunks = max(1, -(-int(size) // max_broadcast_bytes))
    parts = []
    for i in range(chunks):
        piece = short if chunks == 1 else short.filter(F.pmod(F.xxhash64("pid"), F.lit(chunks)) == i)
        parts.append(d.join(F.broadcast(piece), F.col("dtext").contains(F.col("ptext"))).select("pid", "did"))
    out = via_token
    for part in parts:
        out = out.unionByName(part)
    return out.select(F.col("pid").alias(pid), F.col("did").alias(did))


def first_containing(passages: DataFrame, docs: DataFrame, pid: str = "item_id", ptext: str = "text",
                     did: str = "doc_id", dtext: str = "text") -> DataFrame:
    """Truth for text retrieval: lowest document id containing each passage."""
    return contains_join(passages, docs, pid, ptext, did, dtext).groupBy(pid).agg(F.min(did).alias("true_doc"))
