"""Substring deduplication through fixed-block anchors.

Every text is cut into non-overlapping reference blocks, and every rolling window of a block's length
probes them.  With blocks of (window + 1) // 2 words, any repeated window holds a whole block of the text it
is repeated from, so only windows around a hit can repeat.  Those are compared over their whole length and
runs of them grow to the maximal repeats.

Hashes travel packed: texts are dealt into buckets of bounded size, a bucket sends each part of the hash
space one sorted, delta-coded block of its distinct hashes, and the part answers with the ones it shares.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import chunks, hashes, rolling, whole, words

_LOW = np.uint64(0xFFFFFFFF)
_MSG = "part long, bucket long, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as byte planes; the first is sorted and stored as differences."""
    out = [len(arrays[0]).to_bytes(8, "little")]
    for i, a in enumerate(arrays):
        a = np.diff(a, prepend=a.dtype.type(0)) if i == 0 else a
        out.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for i, kind in enumerate(map(np.dtype, kinds)):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        a = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out.append(np.cumsum(a, dtype=kind) if i == 0 else a)
        at += n * kind.itemsize
    return out


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, bucket, payload = zip(*rows) if rows else ((), (), ())
    return pa.table({"part": pa.array(part, pa.int64()), "bucket": pa.array(bucket, pa.int64()), "payload": pa.array(payload, pa.binary())})


def _part_key(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash space in the high half, 32 bits of the hash in the low half."""
    return (((h >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (h & _LOW)


def _texts(table: pa.Table):
    """(ids, buf, off) of pieces of a bucket's documents."""
    for batch in table.combine_chunks().to_batches():
        for part, buf, off in chunks(batch, 1):
            yield part.column(0), buf, off


def _windows(buf, off, ids, n):
    """(word hashes, starts of the n-word windows of texts that have an id, their text's row)."""
    starts, ends, first = words(buf, off)
    h = hashes(buf, starts, ends)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(first))
    at = whole(first, n, len(h))
    known = np.asarray(ids.is_valid())[owner[at]]
    return starts, ends, first, h, at[known], owner


def _sorted_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first places in that order) of the groups of rows with equal keys."""
    order = np.argsort(keys[0], kind="stable")
    if len(keys) > 1:
        k0, k1 = keys[0][order], keys[1][order]
        if len(order) and np.any((k0[1:] == k0[:-1]) & (k1[1:] != k1[:-1])):
            order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    change[:1] = True
    for k in keys:
        k = k[order]
        change[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(change)


def _split(part: np.ndarray, bucket: int, *arrays: np.ndarray):
    """One message for each part; rows are sorted by part and then by the first array."""
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return [(int(part[a]), bucket, _pack(*(x[a:b] for x in arrays))) for a, b in zip(cuts, np.r_[cuts[1:], len(part)])]


def _probe(bucket: int, table: pa.Table, block: int, parts: int) -> pa.Table:
    """The distinct hashes of all rolling windows of ``block`` words; flag 1: it is a reference block,
    flag 2: it occurs in several texts of this bucket."""
    keys, refs, texts, seen = [], [], [], 0
    for ids, buf, off in _texts(table):
        _, _, first, h, at, owner = _windows(buf, off, ids, block)
        keys.append(_part_key(rolling(h, block), parts)[at])
        refs.append((at - first[owner[at]]) % block == 0)
        texts.append(owner[at] + seen)
        seen += len(ids)
    if not keys:
        return _messages([])
    keys, refs, texts = np.concatenate(keys), np.concatenate(refs), np.concatenate(texts)
    order, first = _sorted_groups(keys)
    if not len(order):
        return _messages([])
    flags = np.logical_or.reduceat(refs[order], first).astype(np.uint8)
    t = texts[order]
    flags |= (np.minimum.reduceat(t, first) != np.maximum.reduceat(t, first)).astype(np.uint8) << 1
    keys = keys[order[first]]
    return _messages(_split(keys >> np.uint64(32), bucket, (keys & _LOW).astype(np.uint32), flags))


def _shared(table: pa.Table) -> pa.Table:
    """Of one part: each bucket's hashes that are a reference block and occur in several texts."""
    got = [(b, p, *_unpack(x, np.uint32, np.uint8)) for p, b, x in zip(*(table[c].to_pylist() for c in ("part", "bucket", "payload")))]
    part, keys = got[0][1], np.concatenate([g[2] for g in got])
    flags = np.concatenate([g[3] for g in got])
    order, first = _sorted_groups(keys)
    count = np.diff(np.r_[first, len(order)])
    f = flags[order]
    good = (np.bitwise_or.reduceat(f, first) & 1 > 0) & ((count > 1) | (np.bitwise_or.reduceat(f, first) & 2 > 0))
    keep = np.zeros(len(keys), bool)
    keep[order] = np.repeat(good, count)
    out, at = [], 0
    for b, _, k, _ in got:
        mine = k[keep[at:at + len(k)]]
        at += len(k)
        if len(mine):
            out.append((part, b, _pack(mine)))
    return _messages(out)


def _full_keys(buf, starts, ends, h, window, at):
    return rolling(h, window)[at], rolling(hashes(buf, starts, ends, 1), window, 1)[at]


def _extend(bucket: int, table: pa.Table, hits: pa.Table, window: int, block: int, parts: int) -> pa.Table:
    """The whole windows around the hits: 128 bits of hash and the smallest id of this bucket with them."""
    got = [(np.uint64(p) << np.uint64(32)) | _unpack(x, np.uint32)[0].astype(np.uint64) for p, x in zip(hits["part"].to_pylist(), hits["payload"].to_pylist())]
    if not got:
        return _messages([])
    shared, k1s, k2s, docs = np.sort(np.concatenate(got)), [], [], []
    for ids, buf, off in _texts(table):
        starts, ends, _, h, at, owner = _windows(buf, off, ids, window)
        if not len(at):
            continue
        grams = _part_key(rolling(h, block), parts)
        slot = np.minimum(np.searchsorted(shared, grams), len(shared) - 1)
        hit = np.r_[0, np.cumsum(shared[slot] == grams)]
        at = at[hit[at + window - block + 1] > hit[at]]
        if len(at):
            k1, k2 = _full_keys(buf, starts, ends, h, window, at)
            k1s.append(k1)
            k2s.append(k2)
            docs.append(np.asarray(ids.fill_null(0))[owner[at]])
    if not k1s:
        return _messages([])
    k1, k2, doc = np.concatenate(k1s), np.concatenate(k2s), np.concatenate(docs).astype(np.int64)
    order, first = _sorted_groups(k1, k2)
    low = np.minimum.reduceat(doc[order], first)
    k1, k2 = k1[order[first]], k2[order[first]]
    part = k1 % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return _messages(_split(part[order], bucket, k1[order], k2[order], low[order]))


_FULL = (np.uint64, np.uint64, np.int64)


def _earliest(table: pa.Table) -> pa.Table:
    """Of one part: the smallest id of each window, told to the buckets whose own smallest id is larger."""
    got = [(b, p, *_unpack(x, *_FULL)) for p, b, x in zip(*(table[c].to_pylist() for c in ("part", "bucket", "payload")))]
    k1, k2, doc = (np.concatenate([g[i] for g in got]) for i in (2, 3, 4))
    order, first = _sorted_groups(k1, k2)
    low = np.empty(len(doc), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.r_[first, len(order)]))
    out, at = [], 0
    for b, p, a1, a2, d in got:
        mine = low[at:at + len(d)]
        at += len(d)
        if (less := mine < d).any():
            out.append((p, b, _pack(a1[less], a2[less], mine[less])))
    return _messages(out)


def _lookup(k1, k2, low, r1, r2, r_low):
    """``low`` lowered to r_low where (k1, k2) is among the (r1, r2), which are sorted by r1."""
    if not len(r1):
        return low
    at, low = np.searchsorted(r1, k1), low.copy()
    more = True
    while more:  # again only if several windows have one first hash
        here = np.minimum(at, len(r1) - 1)
        same = (at < len(r1)) & (r1[here] == k1)
        hit = same & (r2[here] == k2)
        low[hit] = np.minimum(low[hit], r_low[here[hit]])
        at = at + 1
        more = bool((same & ~hit).any())
    return low


def _cut(table: pa.Table, hits: pa.Table, window: int, with_text: bool, schema: pa.Schema) -> pa.Table:
    """Counts and kept words of each text of a bucket, given the smaller ids its windows were answered with."""
    got = [_unpack(x, *_FULL) for x in hits["payload"].to_pylist()]
    r1, r2, r_low = (np.concatenate([g[i] for g in got]) if got else np.zeros(0, k) for i, k in enumerate(_FULL))
    order = np.argsort(r1, kind="stable")
    r1, r2, r_low = r1[order], r2[order], r_low[order]
    pieces, k1s, k2s, docs = [], [], [], []
    for ids, buf, off in _texts(table):
        starts, ends, first, h, at, owner = _windows(buf, off, ids, window)
        k1, k2 = _full_keys(buf, starts, ends, h, window, at)
        pieces.append((ids, buf, off, first, at))
        k1s.append(k1)
        k2s.append(k2)
        docs.append(np.asarray(ids.fill_null(0)).astype(np.int64)[owner[at]])
    k1, k2, doc = np.concatenate(k1s), np.concatenate(k2s), np.concatenate(docs)
    low = doc.copy()
    if len(doc):
        order, group = _sorted_groups(k1, k2)
        least = _lookup(k1[order[group]], k2[order[group]], np.minimum.reduceat(doc[order], group), r1, r2, r_low)
        low[order] = np.repeat(least, np.diff(np.r_[group, len(order)]))
    out, done = [], 0
    for ids, buf, off, first, at in pieces:
        hit = at[low[done:done + len(at)] < doc[done:done + len(at)]]
        done += len(at)
        mark = np.zeros(first[-1] + 1, np.int64)
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + window, -1)
        gone = np.cumsum(mark[:-1]) > 0
        for i, doc_id in enumerate(ids.to_pylist()):
            ws, g = buf[off[i]:off[i + 1]].tobytes().split(), gone[first[i]:first[i + 1]]
            n = int(g.sum())
            if n:
                ws = [w for w, x in zip(ws, g.tolist()) if not x]
            kept = b" ".join(ws)
            row = [doc_id, len(g), n, hashlib.sha256(kept).hexdigest()]
            if with_text:
                edge = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
                row += [kept.decode(), edge.tolist()]
            out.append(row)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)


def substring_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                    bucket_bytes: int = 8 << 20, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id (long), n_words, n_removed, kept_sha256; with ``with_text`` also the kept
    words and the maximal repeats (word positions: begin, end, begin, end, ...).

    Words are runs of anything but ASCII blanks, unchanged.  A word goes if it lies in a window of ``window``
    consecutive words that also occurs in a text with a smaller id; windows are judged on the input.  Two
    windows are equal if 128 bits of their hashes are.

    Null and empty texts have no words.  A text with a null id is returned unchanged and removes nothing.
    Texts with one id never remove each other's words.  An empty table gives an empty result; other columns
    are ignored.  A bucket holds about ``bucket_bytes`` of text (at least one whole text), and a part of
    the hash space about as many hashes, however often one window occurs: a bucket sends it once.
    """
    block = (window + 1) // 2
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + int(size) // bucket_bytes
    bucket = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(parts).cast("long"))
    n = min(parts, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + parts // 16))
    dealt = base.withColumn("bucket", bucket).repartition(n, "bucket")  # one exchange, read three times
    of_bucket = dealt.groupBy("bucket")

    def probe(key, table):
        return _probe(key[0].as_py(), table.select(["doc_id", "text"]), block, parts)

    def extend(key, table, hits):
        return _extend(key[0].as_py(), table.select(["doc_id", "text"]), hits, window, block, parts)

    def cut(key, table, hits):
        return _cut(table.select(["doc_id", "text"]), hits, window, with_text, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        *([("text", pa.string()), ("repeats", pa.list_(pa.int64()))] if with_text else [])])
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string, repeats array<long>" * with_text
    hits = of_bucket.applyInArrow(probe, _MSG).groupBy("part").applyInArrow(_shared, _MSG)
    found = of_bucket.cogroup(hits.groupBy("bucket")).applyInArrow(extend, _MSG).groupBy("part").applyInArrow(_earliest, _MSG)
    return of_bucket.cogroup(found.groupBy("bucket")).applyInArrow(cut, ddl)
