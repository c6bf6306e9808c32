"""Prefix trie: brute force over all prefixes, long and copied conversations, odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from hiermatch.llm import trie as T
from hiermatch.llm.queries import QUERIES

from .test_ops import clash, frame

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_convs(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append((t is not None, t or 0, r, x[:64], hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).hexdigest(), x))
    return {c: [(w[2], w[5]) for w in sorted(ws)] for c, ws in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        out[c] = base[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids, words = defaultdict(list), {}
    for p in members:
        words[p] = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, set()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * words[p] + sum(saved[k] for k in kids[p])
        ends = ",".join(str(c) for c in members[p] if len(convs[c]) == len(p))
        out.add((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(rng, n, longest):
    """Conversations that share openings of any length, whole copies, and rows with nulls and ties."""
    word = lambda: " ".join(rng.choice(["a", "b", "", "  c\t"]) for _ in range(rng.randint(0, 3)))
    stems = [[(rng.choice(["user", "assistant", None]), rng.choice([None, word(), word()])) for _ in range(longest)] for _ in range(4)]
    rows = []
    for c in range(n):
        turns = rng.choice(stems)[:rng.randint(0, longest)] + [("user", word()) for _ in range(rng.choice([0, 0, 0, 1, 2, 6]))]
        rows += [(c * rng.choice([1, 1, 1, 7]) if c % 11 else None if c else -3, t if t % 9 else None, r, x) for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,part,longest", [(2, 12, 9), (0, 2, 9), (1, 0, 23), (3, 1, 40), (5, 12, 3)])
def test_trie_brute_force(spark, monkeypatch, block, part, longest):
    monkeypatch.setattr(T, "BLOCK_BITS", block)
    monkeypatch.setattr(T, "PART_BITS", part)
    rows = rows_of(random.Random(longest + block), 80, longest)
    numbered = T.numbered(clash(frame(spark, rows, SCHEMA)))
    convs = numbered.groupBy("conv_id").count().withColumnRenamed("count", "n_turns")
    assert {tuple(r) for r in T.prefix_trie(numbered, convs).collect()} == plain_trie(plain_convs(rows))
    got = T.prefix_trie(*T.share_openings(numbered)).collect()
    want = plain_trie(plain_rebuilt(plain_convs(rows)))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_odd_tables(spark):
    none = T.numbered(frame(spark, [], SCHEMA))
    assert T.prefix_trie(*T.share_openings(none)).count() == 0
    lone = next(c for c in range(21, 99) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(lone, 0, "user", "x"), (lone, 0, "user", "x"), (None, 1, "user", "y")]
    got = T.prefix_trie(*T.share_openings(T.numbered(frame(spark, rows, SCHEMA)))).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    long = T.numbered(frame(spark, [(c, 0, "user", "w " * 1_000_000) for c in (5, 6, 7)], SCHEMA))
    got = T.prefix_trie(long, long.groupBy("conv_id").count().withColumnRenamed("count", "n_turns")).collect()
    assert sorted(tuple(r)[:7] for r in got) == [(5, 0, None, 3, 1, 1, 2_000_000), (5, 1, 5, 3, 0, 1, 2_000_000)]


def test_query_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op11_trie"](spark, sf).collect()} == plain_trie(plain_rebuilt(plain_convs(rows)))
