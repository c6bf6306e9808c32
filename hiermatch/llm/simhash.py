"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, save
from .components import components

SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of ``text``, as an unsigned integer; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    total, ones = len(words) - shingle + 1, np.zeros(64, np.int64)
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, _CHUNK):
        part = words[at:at + _CHUNK + shingle - 1]
        h = np.array([hashed(join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)))], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per input row; fp holds the 64 bits as a signed long."""
    base = id_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return base.mapInArrow(run, f"doc_id {kind}, fp long")


def links(fps: DataFrame, distance: int = 3, col: str = "fp") -> DataFrame:
    """(a, b): every pair of different fingerprints at ``distance`` bits or fewer, once, a < b.

    The 64 bits are cut into as few segments as leave, at that distance, one that differs by at most one
    bit.  Each fingerprint is indexed under its segments and their one-wildcard variants.  Two equal
    segments meet in the segment itself; two that differ in one bit meet in exactly one variant, where one
    has the wildcard bit clear and the other has it set, so each variant is stored for one side only.
    """
    n_seg = (distance + 2) // 2  # distance <= 2 * n_seg - 1: one segment has at most one differing bit
    cuts = [64 * i // n_seg for i in range(n_seg + 1)]
    widths = [hi - lo for lo, hi in zip(cuts, cuts[1:])]
    # Rows are few and short here and 66 times as many below, so their number of partitions is set by hand,
    # and the join must not trust the planner's size, which does not see that growth.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = fps.select(F.col(col).alias("fp")).where("fp is not null").repartition(parts, "fp").distinct()
    variants = variants.withColumn("seg", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(w).alias("w"),
                 F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << w) - 1 if w < 64 else -1)).alias("bits"))
        for i, (lo, w) in enumerate(zip(cuts, widths))])))
    variants = variants.select("fp", "seg.i", "seg.w", "seg.bits").withColumn("p", F.explode(F.sequence(F.lit(0), F.col("w"))))
    variants = variants.select(
        "fp", F.expr("cast(i * 65 + p as int)").alias("slot"),
        F.expr("case when p = w then bits else bits & ~shiftleft(1L, p) end").alias("key"),
        F.expr("case when p = w then 2 else cast(shiftrightunsigned(bits, p) & 1 as int) end").alias("side"),
    )
    left = variants.where("side != 1").select("slot", "key", F.col("fp").alias("a"), "side")
    right = variants.where("side != 0").select("slot", "key", F.col("fp").alias("b"))
    return (
        left.join(right.hint("merge"), ["slot", "key"])
        .where((F.col("side") == 0) | (F.col("a") < F.col("b")))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def simhash_dedup(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Words are runs of anything but ASCII blanks after lower-casing A-Z; a text with fewer words than
    ``shingle`` is one shingle; a null, empty or blank text has fingerprint zero and links like any other.
    Null ids stay in the result and are never a component_id unless the whole component has none.
    Repeated rows are repeated in the result.  An empty table gives an empty result; other columns are
    ignored.  Equal fingerprints are grouped first, so copies cost one index entry.
    """
    prints = save(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    nodes = save(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    comp = save(components(save(links(nodes, distance), "simhash-links")), "simhash-components")
    rooted = nodes.join(comp.withColumnRenamed("node", "fp"), "fp")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    of = save(nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "simhash-classes")
    return prints.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_apart(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, with all its columns: the one with the smallest id, null ids last, and
    of equal ids the one whose text has the smallest SHA-256.

    A document is an (id, text) pair, so different texts under one id (or without one) are judged apart; rows
    that repeat both are one document and stay or go together.  Null and empty texts are equal.  An empty table stays empty.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), digest.alias("digest"))
    found = simhash_dedup(docs.select(key.alias("key"), F.col(text_col).alias("text")), shingle, distance, "key")
    gone = save(found.where("doc_id != component_id").select(F.col("doc_id").alias("gone of key")).distinct(), "simhash-gone")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["gone of key"]["id"]) & (digest == gone["gone of key"]["digest"]), "left_anti")
