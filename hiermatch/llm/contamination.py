"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import id_text, save
from .wordhash import LOWER, NOT_WORD, chunks, hashes, rolling, whole, words

#: Bits of the table that passes most shingles of a document by before the exact lookup.
_TABLE = 24


class _Block:
    """The items of one block: their shingles, and bottom-k MinHash sketches by size class."""

    def __init__(self, items: list[tuple[object, str]], n: int, threshold: float):
        self.items = []  # (id, shingle length, sorted hashes, {hash: exact shingles}, needed)
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.string())], names=["text"])
        at = 0
        for part, buf, off in chunks(batch, 0):
            buf = LOWER[buf]
            starts, ends, first = words(buf, off, NOT_WORD)
            h = hashes(buf, starts, ends)
            for i in range(len(part)):
                lo, hi = first[i], first[i + 1]
                k = min(n, int(hi - lo))
                if k:
                    exact = defaultdict(set)
                    for j, x in enumerate(rolling(h[lo:hi], k).tolist()):
                        exact[x].add(shingle(buf, starts, ends, lo + j, k))
                    size = sum(map(len, exact.values()))
                    self.items.append((items[at + i][0], k, np.array(sorted(exact), np.uint64), dict(exact), size))
            at += len(part)
        # A document that holds a share of at least `threshold` of an item's m shingles misses at most
        # m - ceil(threshold * m) of them, so it holds one of any m - ceil(threshold * m) + 1: the sketch.
        wide = defaultdict(int)
        for _, _, _, _, m in self.items:
            wide[m.bit_length()] = max(wide[m.bit_length()], m - needed(m, threshold) + 1)
        rows = defaultdict(list)
        for at, (_, k, h, _, m) in enumerate(self.items):
            rows[k] += [(x, at) for x in h[:wide[m.bit_length()]].tolist()]
        self.sketches = {}
        for k, pairs in rows.items():
            pairs.sort()
            keys = np.array([x for x, _ in pairs], np.uint64)
            hit = np.zeros(1 << _TABLE, bool)
            hit[(keys & np.uint64((1 << _TABLE) - 1)).astype(np.int64)] = True
            self.sketches[k] = keys, np.array([i for _, i in pairs]), hit


def shingle(buf, starts, ends, at: int, k: int) -> bytes:
    return b" ".join(buf[starts[i]:ends[i]].tobytes() for i in range(at, at + k))


def needed(m: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * m - 1e-9))


def _search(block: _Block, threshold: float, buf, off):
    """(text, item, found) of every text that holds enough of an item's shingles."""
    buf = LOWER[buf]
    starts, ends, first = words(buf, off, NOT_WORD)
    h = hashes(buf, starts, ends)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(first))
    for k, (keys, which, hit) in block.sketches.items():
        at = whole(first, k, len(h))
        grams = rolling(h, k)[at]
        near = np.flatnonzero(hit[(grams & np.uint64((1 << _TABLE) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(keys, grams[near], "left"), np.searchsorted(keys, grams[near], "right")
        pairs = {(int(owner[at[p]]), int(which[s])) for p, a, b in zip(near, lo, hi) for s in range(a, b)}
        ends_of = np.searchsorted(owner[at], np.arange(len(off)))
        for text, item in sorted(pairs):
            _, _, want, exact, m = block.items[item]
            a, b = ends_of[text], ends_of[text + 1]
            slot = np.minimum(np.searchsorted(want, grams[a:b]), len(want) - 1)
            found = {s for p in np.flatnonzero(want[slot] == grams[a:b])
                     if (s := shingle(buf, starts, ends, at[a + p], k)) in exact[int(grams[a + p])]}
            if len(found) >= needed(m, threshold):
                yield text, item, len(found)


def contamination(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, block_bytes: int = 32 << 20,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): the documents that hold at least a share
    ``threshold`` of the distinct ``n``-word shingles of an item.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.  Items are
    grouped by the size class of their shingle set; each has a bottom-k MinHash sketch with the k that its
    class needs so that no document at the threshold can miss it.  Every shingle of every document probes
    the sketches, and each pair found is verified by counting exact shingles.  Items are taken in blocks of
    at most ``block_bytes`` of text (or one longer item), so what a task is sent is bounded.

    An item of fewer than ``n`` words is one shingle of all its words; an item without words (null or empty
    text) is in no document, and a document without words holds no item.  Equal (id, text) items are
    searched once; repeated documents repeat their rows; null ids are carried along.  Empty tables give an
    empty result; other columns are ignored.
    """
    docs = id_text(docs, id_col, text_col)
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    kinds = docs.schema["doc_id"].dataType.simpleString(), wanted.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_shingles long, n_found long, containment double"
    item_type = to_arrow_type(wanted.schema["item_id"].dataType)
    spark, out, block, size = docs.sparkSession, [], [], 0

    def search(block):
        sent = spark.sparkContext.broadcast(_Block(block, n, threshold))

        def run(batches):
            for batch in batches:
                for part, buf, off in chunks(batch, 1):
                    rows = list(_search(sent.value, threshold, buf, off))
                    if not rows:
                        continue
                    found = [sent.value.items[i] for _, i, _ in rows]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array([t for t, _, _ in rows])),
                        pa.array([x[0] for x in found], item_type), pa.array([x[4] for x in found], pa.int64()),
                        pa.array([c for _, _, c in rows], pa.int64()),
                        pa.array([c / x[4] for (_, _, c), x in zip(rows, found)], pa.float64())],
                        names=["doc_id", "item_id", "n_shingles", "n_found", "containment"])

        return save(docs.mapInArrow(run, schema), "contamination")

    for row in wanted.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row.text or "") * 4 > block_bytes:
            out.append(search(block))
            block, size = [], 0
        block.append((row.item_id, row.text or ""))
        size += len(row.text or "") * 4
    if block:
        out.append(search(block))
    result = spark.createDataFrame([], schema)
    for part in out:
        result = result.unionByName(part)
    return result


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    Every text is judged by itself, whatever its id: rows with a null id, or with an id that another text also has,
    go only if their own text holds an item.  Null and empty texts hold none; repeated rows stay or go together.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    texts = docs.select(digest.alias("digest"), F.col(text_col).alias("text"))
    bad = save(contamination(texts, items, id_col="digest", **kw).select("doc_id").distinct(), "contaminated")
    return docs.join(bad.select(F.struct("doc_id").alias("bad of text")), digest == F.col("bad of text.doc_id"), "left_anti")
