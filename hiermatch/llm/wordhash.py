"""Vectorised words and word hashes over the UTF-8 buffer of an Arrow string column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text taken at once inside a task; one longer text is taken alone.
CHUNK = 1 << 19
_U = np.uint64

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Words of ASCII letters, digits and all non-ASCII bytes; anything else separates.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Words of more bytes are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, xor and multiply) that spreads all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def chunks(batch: pa.RecordBatch, text: int):
    """Slices of ``batch`` with about CHUNK bytes of text each, as (slice, buffer, offsets)."""
    col = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    buf = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(off, off[at] + CHUNK, "right")) - 1)
        yield batch.slice(at, to - at), buf[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


def words(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = BLANK):
    """(starts, ends, first): byte ranges of all words; words of text i are first[i]:first[i+1]."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = ~sep[buf]
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    edges = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(buf))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range; ``which`` picks one of two independent hashes.

    Eight bytes at a time go through the finaliser, so that no structure of a word survives, as it does in sums of
    letters times powers.
    """
    n, base = (ends - starts).astype(np.int64), _U(_BASES[which])
    with np.errstate(over="ignore"):
        out = mix(n.astype(_U) * base + base)
        eights = np.lib.stride_tricks.sliding_window_view(np.r_[buf, np.zeros(8, np.uint8)], 8)
        todo = np.flatnonzero((n > 0) & (n <= _LONG))
        for done in range(0, _LONG, 8):
            todo = todo[n[todo] > done]
            if not len(todo):
                break
            block = np.ascontiguousarray(eights[starts[todo] + done]).view("<u8").reshape(-1)
            rest = np.minimum(n[todo] - done, 8).astype(_U)
            block = block & (~_U(0) >> (_U(64) - _U(8) * rest))
            out[todo] = mix((out[todo] ^ block) + base)
    for i in np.flatnonzero(n > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i]:ends[i]].tobytes(), which)
    return out


def rolling(h: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A hash of every n consecutive word hashes (len(h) - n + 1 of them, across texts too)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = np.zeros(m, _U)
        for k in range(n):
            out = out * _U(_BASES[1 - which]) + h[k:k + m]
    return mix(out)


def whole(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Start positions of the n-word windows that lie inside one text."""
    last = np.repeat(first[1:], np.diff(first))  # end of the text of each word
    return np.flatnonzero(np.arange(total) + n <= last)
