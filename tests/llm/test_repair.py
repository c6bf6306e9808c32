"""Conversation repair: a plain dynamic program as brute force, SQL, chunk borders, odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from hiermatch.llm import repair as R
from hiermatch.llm.queries import QUERIES

from .test_ops import clash, frame

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        s = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{s(c)}:{s(t)}".encode()) % 20
        r, x = s(r), s(x)
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        out += [(c, t, r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, [(role, text)])} by states after each row."""
    convs, out = defaultdict(list), {}
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r if r is not None else " ", x if x is not None else " "))
    for c, conv in convs.items():
        conv.sort(key=lambda w: (*w[:3], w[3][:64], hashlib.sha256(f"{len(w[2])}:{w[2]}:{w[3]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, _, r, x in conv:
            body = x.rstrip("\x20\t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (r, x) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        turns = [t for known, t, _, _ in conv if known]
        ini = [r[:1] for _, _, r, _ in conv]
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        other = lambda q: "a" if q == "u" else "u"
        full = {"u": "user", "a": "assistant"}

        def widen(ways):  # any number of inserts
            todo = dict(ways)
            while todo:
                new = {}
                for q, (k, a, ls) in todo.items():
                    w = (k + 5, a + "I", ls + [(full[other(q)], "")])
                    if other(q) not in ways or w[:2] < ways[other(q)][:2]:
                        ways[other(q)] = new[other(q)] = w
                todo = new
            return ways

        ways = widen({"": (0, "", [])})
        for (_, _, r, x), f in zip(conv, faults):
            new = {}
            for q, (k, a, ls) in ways.items():
                options = [(q, k + 2, a + "D", ls)]
                if f in ("", "t"):
                    extra = 5 * (f == "t")
                    if (q, r[:1]) in step:
                        options.append((step[q, r[:1]], k + extra, a + "K", ls + [(r, x)]))
                    options.append((other(q), k + 1 + extra, a + "R", ls + [(full[other(q)], x)]))
                for z, *w in options:
                    if z not in new or tuple(w[:2]) < new[z][:2]:
                        new[z] = tuple(w)
            ways = widen(new)
        k, a, ls = min((ways[q] for q in ("", "a") if q in ways), key=lambda w: w[:2])
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                  sum(p + q not in ("su", "ua", "au") for p, q in zip(ini, ini[1:])), k, a, ls)
    return out


def rows_of(rng, convs, longest):
    out = []
    for c in range(convs):
        for t in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut", "", " \t", "Yes. \n", None, "same.", "x" * 80 + "a.", "x" * 80 + "b.", f"{rng.random()}."])
            out.append((c if c else None, rng.choice([t, t, t, t + 3, None, 5]), role, text))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bits", [12, 2, 0])
def test_repair_brute_force(spark, monkeypatch, bits):
    """Whole conversations in one chunk, and cut into chunks of four rows and of one."""
    monkeypatch.setattr(R, "CHUNK_BITS", bits)
    rows = rows_of(random.Random(bits), 60, 14) + [(900, i, ("user", "assistant", "system")[i * i % 3], f"{i % 17}" + ".?x"[i % 3]) for i in range(300)]
    want = plain_repair(rows)
    df = clash(frame(spark, rows, SCHEMA))
    audits = R.save(R.repair(df), "test-audits")
    assert {r.conv_id: tuple(r)[1:] for r in audits.collect()} == {c: w[:7] for c, w in want.items()}
    turns = defaultdict(list)
    for r in R.repaired_turns(df, audits).collect():
        turns[r.conv_id].append((r.place, r.role, r.text))
    assert {c: sorted(t) for c, t in turns.items()} == {c: [(i + 1, *t) for i, t in enumerate(w[7])] for c, w in want.items() if w[7]}
    sha = {r.conv_id: r.repaired_sha256 for r in R.repaired_digests(df, audits).collect()}
    assert sha == {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in w[7]).encode()).hexdigest() for c, w in want.items()}


def test_auction_prices_are_distances():
    """Against Bellman-Ford on every node of random lattices, exits without a way included."""
    rng = random.Random(7)
    for _ in range(200):
        syms = "".join(rng.choice("SUAXsuaxD") for _ in range(rng.randint(0, 12)))
        exits = [rng.choice([None, 0, 1, 4, 9]) for _ in range(4)]
        graph = R.arcs(syms, exits)
        dist = [float("inf")] * len(graph) + [0]
        for _ in range(len(graph) + 1):
            for i, out in enumerate(graph):
                dist[i] = min([dist[i], *(k + dist[j] for _, j, k in out)])
        assert R.auction(graph) == [None if d == float("inf") else d for d in dist[:-1]]


def test_odd_rows(spark):
    assert R.repair(frame(spark, [], SCHEMA)).count() == 0
    empty = R.repair(frame(spark, [], SCHEMA))
    assert R.repaired_turns(frame(spark, [], SCHEMA), empty).count() == 0
    rows = [("k", 1, "user", "a" * 3_000_000 + "."), ("k", 1, "user", "a" * 3_000_000 + "."), ("k", None, "assistant", " " * 1_000_000), (None, 2, None, None)]
    got = {r.conv_id: tuple(r)[1:] for r in R.repair(frame(spark, rows, "conv_id string, turn int, role string, text string")).collect()}
    assert got == {"k": (0, 1, 1, 0, 1, 6, "DDD"), None: (0, 1, 0, 0, 0, 2, "D")}


@pytest.mark.parametrize("extra", [0, 1])
def test_query_brute_force(spark, sf, tmp_path, extra):
    """The query against brute force on the whole table, and on one with nulls, ties and a turnless conversation."""
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    if extra:
        lost = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
        df = df.unionByName(frame(spark, rows_of(random.Random(3), 30, 9) + [(lost, 0, "user", "Gone.")], SCHEMA))
    path = str(tmp_path)
    df.write.parquet(f"{path}/conversations.parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_repair(plain_damage(rows))
    sha = lambda ls: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in ls).encode()).hexdigest()
    full = {c: (0, 0, 0, 0, 0, 0, "", sha([])) for c, *_ in rows} | {c: (*w[:7], sha(w[7])) for c, w in want.items()}
    assert {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, path).collect()} == full
