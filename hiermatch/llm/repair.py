"""Conversation structure repair by an auction for shortest paths.

A conversation's rows and the four places of the role pattern ``(s?(ua)+)?`` (nothing yet, after s, after u,
after a) span a lattice; every edit is an arc with an integer cost.  An auction raises node prices: from an
origin a path is extended along the arc that is cheapest at the current prices, and contracted with a higher price
for its last node when no arc is tight.  Origins are taken from the last row to the first, and a path ends at the
destination or at a node whose price has converged.  Converged prices are distances to the destination, so
the arcs tight under them are the cheapest edits; following the ASCII-least tight arc from the start gives the audit.

Rows become one symbol each, and a conversation a string of symbols in chunks of at most CHUNK rows.  Equal
chunks are solved once.  Of a conversation with more chunks, the chunks' entry-to-exit prices are folded from the
last to the first, which gives each chunk its exit prices, so no task ever holds a whole conversation's lattice.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import save

#: Rows of a chunk: 2^12.
CHUNK_BITS = 12
# Costs of the edits.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANKS = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
#: After a role: s, u or a; the place it leads to from each place, or nothing.
PLACES = {"S": (1, None, None, None), "U": (2, 2, None, 2), "A": (None, None, 3, None)}
#: The place that an inserted or rerolled turn leads to; it is a user turn unless one stands last.
NEXT = (2, 2, 3, 2)
END = "0,,,0"


# one chunk -------------------------------------------------------------------------------------------

def arcs(syms: str, exits: list) -> list[list[tuple[str, int, int]]]:
    """(edit, head, cost) of the arcs of each node row * 4 + place; node -1 is the destination."""
    out = []
    for i, sym in enumerate(syms):
        extra = TRUNCATED * sym.islower()
        for q in range(4):
            node = [("D", 4 * i + 4 + q, DELETE), ("I", 4 * i + NEXT[q], INSERT)]
            if sym != "D":
                keep = PLACES.get(sym.upper(), (None,) * 4)[q]
                if keep is not None:
                    node.append(("K", 4 * i + 4 + keep, extra))
                node.append(("R", 4 * i + 4 + NEXT[q], REROLE + extra))
            out.append(node)
    n = 4 * len(syms)
    for q in range(4):
        out.append(([("", -1, exits[q])] if exits[q] is not None else []) + [("I", n + NEXT[q], INSERT)])
    return out


def auction(graph: list) -> list:
    """Converged price of every node: its distance to the destination, None where there is no way."""
    price, far = [0] * len(graph) + [0], 7 * len(graph) + 100  # the last entry is node -1
    solved = [False] * len(graph) + [True]
    for origin in range(len(graph) - 1, -1, -1):
        path = [origin]
        while not solved[path[-1]]:
            at = path[-1]
            best, head = far, None
            for _, j, cost in graph[at]:
                if cost + price[j] < best:
                    best, head = cost + price[j], j
            if price[at] == best < far:
                path.append(head)
                continue
            price[at], solved[at] = best, best >= far  # contract; beyond every finite way there is none
            if len(path) > 1:
                path.pop()
        for at in path:
            solved[at] = True
    return [p if p < far else None for p in price[:-1]]


def trace(graph: list, price: list, at: int) -> tuple[str, int, int]:
    """(audit, cost without the exit's price, place at the exit) along the ASCII-least tight arcs from ``at``."""
    audit, total, n = [], 0, len(graph) - 4
    while True:
        edit, head, cost = min(a for a in graph[at] if (a[1] < 0 or price[a[1]] is not None)
                               and price[at] == a[2] + (0 if a[1] < 0 else price[a[1]]))
        if head < 0:
            return "".join(audit), total, at - n
        audit.append(edit)
        at, total = head, total + cost


def _read(exits: str) -> list:
    return [int(x) if x else None for x in exits.split(",")]


def _solve(batches):
    """For each (syms, exits): audit, cost and exit place from each entry place."""
    for batch in batches:
        rows = []
        for syms, exits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            graph = arcs(syms, _read(exits))
            price = auction(graph)
            rows.append([trace(graph, price, q) if price[q] is not None else ("", 0, None) for q in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(
            pa.array([[w[k] for w in r] for r in rows], pa.list_(t)) for k, t in enumerate((pa.string(), pa.int64(), pa.int64())))],
            ["syms", "exits", "audits", "costs", "ends"])


def _prices(batches):
    """For each syms: the 16 prices from entry to exit place, -1 where there is no way."""
    for batch in batches:
        rows = []
        for syms in batch.column(0).to_pylist():
            by_exit = [auction(arcs(syms, [0 if x == y else None for y in range(4)]))[:4] for x in range(4)]
            rows.append([-1 if by_exit[x][e] is None else by_exit[x][e] for e in range(4) for x in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["syms", "prices"])


def _backward(batches):
    """Chunks of sorted conversations from the last to the first: each one's exit prices, the least being 0."""
    conv = exits = None
    for batch in batches:
        out = []
        for c, prices in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if exits is None or c != conv:
                conv, exits = c, _read(END)
            out.append(",".join("" if x is None else str(x) for x in exits))
            ways = [[prices[4 * e + x] + exits[x] for x in range(4) if prices[4 * e + x] >= 0 and exits[x] is not None] for e in range(4)]
            exits = [min(w) if w else None for w in ways]
            low = min(x for x in exits if x is not None)
            exits = [None if x is None else x - low for x in exits]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.string())], ["conv_id", "chunk", "syms", "exits"])


def _forward(batches):
    """Chunks of sorted conversations from the first to the last: the audit and cost from the place reached."""
    conv = place = None
    for batch in batches:
        audits, costs = [], []
        for c, a, k, e in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
            if place is None or c != conv:
                conv, place = c, 0
            audits.append(a[place])
            costs.append(k[place])
            place = e[place]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(audits, pa.string()), pa.array(costs, pa.int64())], ["conv_id", "chunk", "audit", "cost"])


# conversations ---------------------------------------------------------------------------------------

def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows with what orders them; equal rows are interchangeable."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    return turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).select(
        "*", F.substring("text", 1, 64).alias("head"), F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("key"))


_ORDER = [F.asc_nulls_first, F.asc, F.asc, F.asc]


def _order() -> list[Column]:
    return [f(c) for f, c in zip(_ORDER, ("turn", "role", "head", "key"))]


def _on(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on null-safe keys, keeping the left ones."""
    right = right.select(*(F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns))
    cond = None
    for k in keys:
        same = left[k].eqNullSafe(right[f"_{k}"])
        cond = same if cond is None else cond & same
    return left.join(right, cond, how).drop(*(f"_{k}" for k in keys))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows.

    Rows are taken by turn (null first), then role, the text's first 64 characters, and a SHA-256.  Each counts for its first fault: blank (no
    character but blanks), duplicate (role and text seen before in the conversation), truncated (the last such character
    is none of ``.!?``).  ``gaps`` are missing turn numbers, ``illegal`` neighbouring role initials that are not su, ua
    or au.  ``audit`` is the cheapest edit script, D(elete), I(nsert), K(eep) or R(erole) per letter, that leaves the
    roles ``(s?(ua)+)?``; of equal costs the ASCII-least.

    Null role or text is one space.  A null conv_id is a conversation of its own, a null turn comes first and counts
    for no gap.  Repeated rows are duplicates.  An empty table gives no row.  Only the four named columns are read.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    slim = rows.select("conv_id", "turn", "role", "head", "key", (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("open"))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ids that rise in order inside ranges: a chunk is a conversation's rows in one run of 2^12 ids.
    order, first = [F.asc_nulls_first("conv_id"), *_order()], F.substring("role", 1, 1)
    slim = save(slim.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .select("conv_id", "turn", "key", "blank", "open", F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("ini"),
                        F.monotonically_increasing_id().alias("gid")), "repair-rows")
    seen = slim.groupBy("conv_id", "key").agg(F.min("gid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = _on(slim, seen, "conv_id", "key", how="left").withColumn("again", ~F.col("blank") & F.coalesce(F.col("gid") > F.col("first"), F.lit(False)))
    marked = marked.withColumn("cut", F.col("open") & ~F.col("blank") & ~F.col("again"))
    sym = F.when(F.col("blank") | F.col("again"), "D").when(F.col("cut"), F.col("ini")).otherwise(F.upper("ini"))
    letters = F.array_sort(F.collect_list(F.struct("gid", sym.alias("sym"), "ini")))
    text_of = lambda field: F.array_join(F.transform("letters", lambda x: x[field]), "")
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    chunks = marked.groupBy("conv_id", F.shiftright("gid", CHUNK_BITS).alias("chunk")).agg(
        letters.alias("letters"), count("blank"), count("again"), count("cut"))
    chunks = chunks.select("conv_id", "chunk", "blank", "again", "cut", text_of("sym").alias("syms"), text_of("ini").alias("inis"))
    w = Window.partitionBy("conv_id").orderBy("chunk")
    legal = sum(((F.length("inis") - F.length(F.replace("inis", F.lit(p), F.lit("")))) / 2).cast("long") for p in ("su", "ua", "au"))
    seam = F.concat(F.lag(F.substring("inis", -1, 1)).over(w), F.substring("inis", 1, 1)).isin("su", "ua", "au")
    chunks = save(chunks.select("*", legal.alias("legal"), F.coalesce(seam.cast("long"), F.lit(0)).alias("seam"),
                                F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_chunks")), "repair-chunks")
    counts = chunks.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("blank", "again", "cut")),
                                           (F.sum(F.length("inis") - F.col("legal") - F.col("seam")) - 1).alias("illegal"))
    spread = slim.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    whole = _on(_on(counts, spread, "conv_id"), _audits(chunks), "conv_id")
    return whole.select("conv_id", "gaps", "blank", F.col("again").alias("duplicate"), F.col("cut").alias("truncated"), "illegal", "cost", "audit")


def _audits(chunks: DataFrame) -> DataFrame:
    """(conv_id, cost, audit): equal chunks solved once, several chunks of a conversation linked by exit prices."""
    single = chunks.where("n_chunks = 1").select("conv_id", "chunk", "syms", F.lit(END).alias("exits"))
    many = chunks.where("n_chunks > 1").select("conv_id", "chunk", "syms")
    costs = many.select("syms").distinct().mapInArrow(_prices, "syms string, prices array<long>")
    id_type = chunks.schema["conv_id"].dataType.simpleString()
    linked = (many.join(costs, "syms").select("conv_id", "chunk", "syms", "prices")
              .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
              .mapInArrow(_backward, f"conv_id {id_type}, chunk long, syms string, exits string"))
    todo = save(single.union(linked), "repair-todo")
    ways = todo.select("syms", "exits").distinct().mapInArrow(_solve, "syms string, exits string, audits array<string>, costs array<long>, ends array<long>")
    done = todo.join(ways, ["syms", "exits"])
    pieces = (done.select("conv_id", "chunk", "audits", "costs", "ends").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
              .mapInArrow(_forward, f"conv_id {id_type}, chunk long, audit string, cost long"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    return pieces.groupBy("conv_id").agg(F.sum("cost").alias("cost"), parts.alias("parts")).select(
        "conv_id", "cost", F.array_join(F.transform("parts", lambda x: x["audit"]), "").alias("audit"))


def _edited(batches):
    """(conv_id, [(role, text, edit)] or None at its end) along rows sorted by conversation, its audit row first."""
    conv, audit, at, place, begun = None, "", 0, 0, False

    def inserts():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield ("assistant" if place == 2 else "user"), "", "I"
            at, place = at + 1, NEXT[place]

    for batch in batches:
        for c, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if kind == 0:
                if begun:
                    yield from ((conv, t) for t in inserts())
                    yield conv, None
                conv, audit, at, place, begun = c, text, 0, 0, True
                continue
            yield from ((conv, t) for t in inserts())
            edit, at = audit[at], at + 1
            if edit == "K":
                place = PLACES[role[0].upper()][place]
                yield conv, (role, text, "K")
            elif edit == "R":
                yield conv, ("assistant" if place == 2 else "user", text, "R")
                place = NEXT[place]
    if begun:
        yield from ((conv, t) for t in inserts())
        yield conv, None


def _streamed(turns: DataFrame, audits: DataFrame, cols: tuple) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition; nothing is held there but the audit."""
    rows = _rows(turns, *cols)
    head = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = head.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "kind", *_order())
    return both.select("conv_id", "kind", "role", "text")


def repaired_turns(turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, place, role, text, edit) of the rows that the audits leave: kept, rerolled and inserted ones.

    ``audits`` is the result of :func:`repair` on the same rows.
    """
    streamed = _streamed(turns, audits, (conv_col, turn_col, role_col, text_col))
    id_type = streamed.schema["conv_id"].dataType
    arrow = to_arrow_type(id_type)

    def run(batches):
        buf, place, size = [], 0, 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([r[0] for r in buf], arrow), pa.array([r[1] for r in buf], pa.int64()),
                                                    *(pa.array([r[k] for r in buf], pa.string()) for k in (2, 3, 4))], ["conv_id", "place", "role", "text", "edit"])
        for conv, turn in _edited(batches):
            if turn is None:
                place = 0
                continue
            place += 1
            buf.append((conv, place, *turn))
            size += len(turn[1])
            if len(buf) >= 5000 or size > 1 << 22:
                yield flush()
                buf, size = [], 0
        if buf:
            yield flush()

    return streamed.mapInArrow(run, f"conv_id {id_type.simpleString()}, place long, role string, text string, edit string")


def repaired_digests(turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of each conversation's repaired ``role:text`` lines, joined by newlines."""
    streamed = _streamed(turns, audits, (conv_col, turn_col, role_col, text_col))
    id_type = streamed.schema["conv_id"].dataType
    arrow = to_arrow_type(id_type)

    def run(batches):
        out, digest, first = [], hashlib.sha256(), True
        for conv, turn in _edited(batches):
            if turn is None:
                out.append((conv, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                continue
            digest.update(f"{'' if first else chr(10)}{turn[0]}:{turn[1]}".encode())
            first = False
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], arrow), pa.array([d for _, d in out], pa.string())], ["conv_id", "repaired_sha256"])

    return streamed.mapInArrow(run, f"conv_id {id_type.simpleString()}, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """``conversations`` rows with planted faults, chosen by crc32 of ``conv_id:turn``; every null is one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = turns.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind")).where("kind != 0")
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
