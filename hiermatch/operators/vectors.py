"""Vector retrieval (R4-R9): embedding jobs and exact / approximate k-NN.

Exact k-NN works on a clustered vector table (:func:`cluster`): a bounded number of pivots is drawn from the
catalog and every vector goes to its nearest pivot, so each cluster has a centre and an outer and inner
radius.  Neighbouring clusters are taken together as parts, and queries as slices, of bounded size in bytes; a cell of the
work is one part with the queries of one slice that need it.  A query

1. looks at the parts of its nearest clusters until these hold k vectors, which bounds its k-th distance, and
2. then at the parts with clusters that the triangle inequality lets come nearer than that, and there only at these.

Nothing is cut: a cluster is skipped only if none of its vectors can be among the k.  A cell multiplies blocks of
queries by blocks of a cluster and keeps k rows per query between them, so its memory is that of its two sides.  A
vector travels once per part or slice, not once per cluster, and only k rows per query and cell are shuffled.

Distances are squared L2 by default (what a flat L2 index returns).  The fast ||q||^2 + ||c||^2 - 2 q.c form
only preselects, within a tolerance that grows with the norms; survivors are recomputed as sum((q - c)^2)
and ranked on that value rounded to 9 places, ties by id.  Rows with a null id or vector are no neighbours
and get none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path, shuffled

DEFAULT_BLOCK_ROWS = 4096
#: Pivots are collected and sent to every task, so their number is bounded.
MAX_PIVOTS = 1024
#: Bytes of vectors on one side of a cell.
CELL_BYTES = 32 << 20
#: Each side is dealt to about this many cells if it has that many times SHARE_ROWS.
SHARES, SHARE_ROWS, MAX_TASKS = 6, 4096, 4096


def to_double_array(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("array<double>")


def similarity(distance: Column) -> Column:
    """1 / (1 + distance)."""
    return F.lit(1.0) / (F.lit(1.0) + distance)


def relevance(distance: Column) -> Column:
    """Euclidean relevance 1 - distance / sqrt(2), unclamped."""
    return F.lit(1.0) - distance / F.lit(math.sqrt(2.0))


_ROW_CHUNK = 512  # query rows per vectorised step inside a cell
_PAIR_CHUNK = 1 << 16  # pairs recomputed exactly at once


def _squared(Q, C):
    """Fast squared distances and a bound of their rounding error per row of Q."""
    qn, cn = (Q * Q).sum(1), (C * C).sum(1)
    d2 = qn[:, None] + cn[None, :] - 2.0 * (Q @ C.T)
    error = 4e-16 * (Q.shape[1] + 8) * (qn + (cn.max() if len(cn) else 0.0)) + 1e-12
    return np.maximum(d2, 0.0, out=d2), error


def _exact(Q, C, rows, cols):
    out = np.empty(len(rows))
    for s in range(0, len(rows), _PAIR_CHUNK):
        diff = C[cols[s:s + _PAIR_CHUNK]] - Q[rows[s:s + _PAIR_CHUNK]]
        out[s:s + _PAIR_CHUNK] = np.einsum("ij,ij->i", diff, diff)
    return out


@dataclass
class VectorIndex:
    vectors: DataFrame  # cluster int, cid, v array<double>
    centres: DataFrame  # cluster int, centre array<double>, n long, inner double, outer double (at most MAX_PIVOTS rows)


def cluster(catalog: DataFrame, cid: str = "doc_id", cvec: str = "embedding", block_rows: int = DEFAULT_BLOCK_ROWS,
            pivots: int | None = None, path: str | None = None) -> VectorIndex:
    """R5 index: vectors dealt to their nearest pivot, written as tables and opened (default: a new shared folder).

    Pivots are the catalog vectors with the smallest hash of their id, about four for each full block of rows.
    """
    spark = catalog.sparkSession
    path = path or shared_path(spark, "vector-index")
    c = catalog.select(F.col(cid).alias("cid"), to_double_array(cvec).alias("v")).where("cid is not null")
    c.write.parquet(f"{path}/given")  # embedded once: it is counted, ordered and dealt
    # Rows without a vector leave here: a filter on it before would embed once more, below the exchange.
    c = spark.read.schema(c.schema).parquet(f"{path}/given").where("v is not null")
    n = c.count()
    pivots = max(1, min(pivots or max(8, 4 * math.ceil(n / block_rows)), MAX_PIVOTS))
    centres = [r.v for r in c.orderBy(F.xxhash64("cid"), "cid").limit(pivots).collect()]
    P = np.array(centres, np.float64) if centres else np.zeros((0, 0))

    def assign(it):
        for pdf in it:
            V = np.stack(pdf["v"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, P.shape[1]))
            best = np.concatenate([_squared(V[s:s + _ROW_CHUNK], P)[0].argmin(1) for s in range(0, len(V), _ROW_CHUNK)] or [np.zeros(0, int)])
            yield pdf.assign(cluster=best.astype(np.int32), d=np.sqrt(_exact(V, P, np.arange(len(V)), best)))

    kind = c.schema["cid"].dataType.simpleString()
    c.mapInPandas(assign, f"cid {kind}, v array<double>, cluster int, d double").write.parquet(f"{path}/vectors")
    placed = spark.read.parquet(f"{path}/vectors")
    stats = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("inner"), F.max("d").alias("outer"))
    rows = [(r["cluster"], centres[r["cluster"]], r["n"], r["inner"], r["outer"]) for r in stats.collect()]
    spark.createDataFrame(rows, "cluster int, centre array<double>, n long, inner double, outer double").write.parquet(f"{path}/centres")
    return read_vectors(spark, path)


def read_vectors(spark: SparkSession, path: str) -> VectorIndex:
    """The index that :func:`cluster` wrote."""
    return VectorIndex(spark.read.parquet(f"{path}/vectors").select("cluster", "cid", "v"), spark.read.parquet(f"{path}/centres"))


def _share(rows: int, dim: int) -> int:
    """Rows of one side of a cell."""
    return min(max(1, CELL_BYTES // (8 * max(dim, 1))), max(SHARE_ROWS, math.ceil(rows / SHARES)))


class _Geometry:
    """Clusters by number, and the parts that they lie in: neighbouring small clusters share one, large ones have several."""

    def __init__(self, centres: list):
        self.ids = np.array([c["cluster"] for c in centres], np.int32)
        self.P = np.array([c["centre"] for c in centres], np.float64)
        self.n, self.inner, self.outer = (np.array([c[x] for c in centres]) for x in ("n", "inner", "outer"))
        rows = _share(int(self.n.sum()), self.P.shape[1])
        self.first, self.count = np.zeros(len(centres), np.int64), np.ceil(self.n / rows).astype(np.int64)
        apart, held, at, todo = 0, 0, 0, np.ones(len(centres), bool)
        for _ in centres:
            todo[at] = False
            if held and held + self.n[at] > rows:
                apart, held = apart + 1, 0
            self.first[at], held = apart, held + self.n[at]
            if self.count[at] > 1:
                apart, held = apart + self.count[at], 0
            left = np.nonzero(todo)[0]
            if len(left):
                at = left[_squared(self.P[at:at + 1], self.P[left])[0][0].argmin()]
        self.parts = int((self.first + self.count).max())

    def near(self, d, rows: int):
        """The nearest clusters until they hold ``rows`` vectors."""
        near = np.zeros(d.shape, bool)
        first = d.argmin(1)
        near[np.arange(len(d)), first] = True
        more = np.nonzero(self.n[first] < rows)[0]  # one is seldom too small, so few rows are sorted
        order = np.argsort(d[more], axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        some = np.zeros(order.shape, bool)
        np.put_along_axis(some, order, before < rows, axis=1)
        near[more] = some
        return near


def _reach(d, error, goal, inner, outer):
    """Whether a cluster at distance ``d`` may hold a vector that is as near as ``goal``."""
    slack = np.sqrt(error) + 1e-6 + 1e-9 * np.where(np.isinf(goal), 0.0, goal)
    return (d - outer <= goal + slack) & (inner - d <= goal + slack)


def _probe_fn(g: _Geometry, rows: int, far: bool):
    """For a batch of queries: the parts to look at, first of near clusters (``far`` false) and then, given the
    distance ``goal`` of the k-th neighbour found there, all that may hold as near ones."""
    every = np.zeros((len(g.n), g.parts), np.float32)
    for i in range(len(g.n)):
        every[i, g.first[i]:g.first[i] + g.count[i]] = 1.0

    def fn(it):
        for pdf in it:
            for s in range(0, len(pdf), _ROW_CHUNK):
                part = pdf.iloc[s:s + _ROW_CHUNK]
                Q = np.stack(part["v"].to_numpy()).astype(np.float64)
                d2, error = _squared(Q, g.P)
                d = np.sqrt(d2)
                if far:
                    goal = part["goal"].fillna(np.inf).to_numpy(np.float64)[:, None]
                    wanted = _reach(d, error[:, None], goal, g.inner, g.outer).astype(np.float32) @ every > 0
                else:  # one part of each near cluster holds enough
                    row, col = np.nonzero(g.near(d, rows))
                    wanted = np.zeros((len(Q), g.parts), bool)
                    wanted[row, g.first[col] + row % g.count[col]] = True
                yield part[["query_id", "v", "goal"]].assign(parts=[np.nonzero(w)[0].astype(np.int32) for w in wanted])

    return fn


def _matrix(vectors) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]) if vectors.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _best(k, place, rows, cols, exact):
    """The first ``k`` pairs of every row by distance and id."""
    order = np.lexsort((place[cols], np.round(exact, 9), rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep], exact[keep]


def _nearest(Q, qid, goal, C, B, cid, place, spans, k: int, exclude_self: bool, block_rows: int):
    """(row, column, distance) of the k nearest of ``C`` to each of a chunk of queries, but none beyond its ``goal``.
    ``spans`` has (centre, inner, outer, start, end, longest) of the clusters in C; ``B`` has the vectors less their centre,
    and the squared norm of that, whose ``longest`` root the span gives.

    A block is preselected by one product, |c - m|^2 - 2 (q - m).(c - m) for the centre m, in the precision of ``B``; its
    rounding error is bounded by the distances to the centre, so it is small wherever the vectors lie.
    """
    d2, error = _squared(Q, np.array([s[0] for s in spans]))
    d, bound = np.sqrt(d2), goal.copy()
    got = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    pending, waiting = [got], 0
    eps = (Q.shape[1] + 16) * np.finfo(B.dtype).eps
    for j in np.argsort(d.min(0), kind="stable"):
        centre, inner, outer, start, end, longest = spans[j]
        if not _reach(d[:, j], error, bound, inner, outer).any():
            continue
        A = np.empty((len(Q), Q.shape[1] + 1), B.dtype)
        away = Q - centre
        A[:, :-1], A[:, -1] = -2.0 * away, 1.0
        qn = (away * away).sum(1)
        wrong = eps * (2.0 * np.sqrt(qn) * longest + longest * longest) + 1e-15 * qn
        for s in range(start, end, block_rows):
            need = np.nonzero(_reach(d[:, j], error, bound, inner, outer))[0]
            if not len(need):
                break
            part = A if len(need) == len(A) else A[need]
            S = part @ B[s:min(s + block_rows, end)].T
            limit = ((bound[need] * (1 + 1e-9) + 1e-6) ** 2 - qn[need] + 2 * wrong[need] + 1e-8).astype(B.dtype)
            hits = S <= np.nextafter(limit, B.dtype.type(np.inf))[:, None]
            want = min(k + exclude_self, S.shape[1])
            if np.count_nonzero(hits) > 4 * k * len(need):
                nth = np.partition(S, want - 1, axis=1)[:, want - 1] + 2 * wrong[need] + 1e-8
                hits &= S <= np.nextafter(nth.astype(B.dtype), B.dtype.type(np.inf))[:, None]
            rows, cols = np.divmod(np.flatnonzero(hits), S.shape[1])
            rows, cols = need[rows], cols + s
            if exclude_self:
                other = qid[rows] != cid[cols]
                rows, cols = rows[other], cols[other]
            pending.append((rows, cols, _exact(Q, C, rows, cols)))
            waiting += len(rows)
            if waiting > 2 * k * len(Q) or np.isinf(bound).any():
                got = _best(k, place, *map(np.concatenate, zip(*pending)))
                pending, waiting = [got], 0
                last = np.searchsorted(got[0], np.arange(len(Q))) + k - 1
                full = np.nonzero(np.bincount(got[0], minlength=len(Q)) >= k)[0]
                bound[full] = np.minimum(bound[full], np.sqrt(got[2][last[full]]))
    return _best(k, place, *map(np.concatenate, zip(*pending)))


def _cell_fn(g: _Geometry, k: int, exclude_self: bool, row_chunk: int, block_rows: int):
    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        outs = [pa.table({"query_id": left["query_id"].slice(0, 0), "doc_id": right["cid"].slice(0, 0), "distance": pa.array([], pa.float64())})]
        if len(left) and len(right):
            right = right.take(np.argsort(right["cluster"].to_numpy(), kind="stable"))
            Q_all, C = _matrix(left["v"]), _matrix(right["v"])
            qid_all, cid = (t[c].to_numpy() for t, c in ((left, "query_id"), (right, "cid")))
            goal = left["goal"].to_numpy().astype(np.float64)
            goal = np.where(np.isnan(goal), np.inf, goal)
            place = np.unique(cid, return_inverse=True)[1]  # ids in order, whatever their type
            held, starts = np.unique(right["cluster"].to_numpy(), return_index=True)
            at = np.searchsorted(g.ids, held)
            # Single precision is enough to preselect, unless squares leave its range.
            most = max(np.abs(Q_all).max(initial=0.0), np.abs(C).max(initial=0.0))
            B = np.empty((len(C), C.shape[1] + 1), np.float32 if most < 1e15 else np.float64)
            longest = []
            for i, s, e in zip(at, starts, [*starts[1:], len(C)]):
                away = C[s:e] - g.P[i]
                B[s:e, :-1], norms = away, (away * away).sum(1)
                B[s:e, -1] = norms
                longest.append(np.sqrt(np.fmax.reduce(norms)))
            spans = list(zip(g.P[at], g.inner[at], g.outer[at], starts, [*starts[1:], len(C)], longest))
            home = np.concatenate([_squared(Q_all[s:s + _ROW_CHUNK], g.P[at])[0].argmin(1) for s in range(0, len(Q_all), _ROW_CHUNK)])
            order = np.argsort(home, kind="stable")  # queries of one chunk lie near each other
            for s in range(0, len(order), row_chunk):
                now = order[s:s + row_chunk]
                rows, cols, exact = _nearest(Q_all[now], qid_all[now], goal[now], C, B, cid, place, spans, k, exclude_self, block_rows)
                outs.append(pa.table({"query_id": left["query_id"].take(now[rows]), "doc_id": right["cid"].take(cols), "distance": exact}))
        return pa.concat_tables(outs)

    return fn


def knn(queries: DataFrame, catalog: DataFrame | None, k: int, *args, **kw) -> DataFrame:
    """R5 exact: (query_id, doc_id, distance, rank) with rank <= k; k larger than the catalog is legal.  Arguments are
    those of :func:`knn_lists`."""
    return knn_lists(queries, catalog, k, *args, **kw).select("query_id", F.inline(F.arrays_zip("doc_id", "distance", "rank")))


def knn_lists(queries: DataFrame, catalog: DataFrame | None, k: int, qid: str = "query_id", cid: str = "doc_id",
        qvec: str = "embedding", cvec: str = "embedding", exclude_self: bool = False, squared: bool = True,
        query_block_rows: int = 65_536, catalog_block_rows: int = DEFAULT_BLOCK_ROWS,
        index: VectorIndex | None = None) -> DataFrame:
    """R5 exact, a row a query: (query_id, doc_id, distance, rank) as arrays of one length.

    ``index`` is a prebuilt clustered table; without it one is built from ``catalog``.  The block rows bound one matrix
    product inside a cell; how queries and catalog are dealt to cells follows from their size alone.
    """
    index = index or cluster(catalog, cid, cvec, catalog_block_rows)
    centres = index.centres.orderBy("cluster").collect()  # at most MAX_PIVOTS rows
    q = queries.select(F.col(qid).alias("query_id"), to_double_array(qvec).alias("v"))
    kind = q.schema["query_id"].dataType.simpleString()
    schema = T.StructType([T.StructField("query_id", q.schema["query_id"].dataType),
                           T.StructField("doc_id", index.vectors.schema["cid"].dataType), T.StructField("distance", T.DoubleType())])
    if not centres:
        empty = queries.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", *[F.array(c).alias(c) for c in ("doc_id", "distance")], F.array(F.lit(0)).alias("rank"))
    asked = _asked(q, apart=exclude_self)
    q = asked.select(F.col("of").alias("query_id"), F.explode("vs").alias("v"))
    g = _Geometry(centres)
    n_queries = q.count()
    slices = max(1, math.ceil(n_queries / _share(n_queries, g.P.shape[1])))
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 9).asc(), F.col("doc_id").asc())
    layout = F.broadcast(queries.sparkSession.createDataFrame(
        [(int(c), int(f), int(m)) for c, f, m in zip(g.ids, g.first, g.count)], "cluster int, first int, of int"))
    vectors = index.vectors.join(layout, "cluster").select(
        (F.col("first") + F.pmod(F.xxhash64("cid"), F.col("of"))).cast("int").alias("part"), "cluster", "cid", "v")
    # Two partitions a cell: long cells are not joined into one task.
    n_cells = min(2 * slices * g.parts, MAX_TASKS)

    def solve(rows: DataFrame, far: bool) -> DataFrame:
        probes = rows.mapInPandas(_probe_fn(g, k + exclude_self, far), f"query_id {kind}, v array<double>, goal double, parts array<int>")
        probes = probes.select("query_id", "v", "goal", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int").alias("slice"), F.explode("parts").alias("part"))
        # the parts of the catalog that are needed, once for each slice of queries that needs them
        pairs = F.broadcast(probes.select("part", "slice").distinct())
        theirs = vectors.join(pairs, "part").select(F.col("part").alias("of_part"), F.col("slice").alias("of_slice"), "cluster", "cid", "v")
        mine = probes.select("part", "slice", "query_id", "v", "goal").repartition(n_cells, "part", "slice")
        cells = mine.groupBy("part", "slice").cogroup(theirs.repartition(n_cells, "of_part", "of_slice").groupBy("of_part", "of_slice"))
        return cells.applyInArrow(_cell_fn(g, k, exclude_self, min(query_block_rows, _ROW_CHUNK), catalog_block_rows), schema)

    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("distance"))
    first = solve(q.withColumn("goal", F.lit(None).cast("double")), False).select("query_id", "distance").withColumn("n", nth).where(F.col("n") <= k)
    goal = first.where(F.col("n") == k).select("query_id", F.sqrt("distance").alias("goal"))
    out = solve(q.join(shuffled(goal), "query_id", "left").select("query_id", "v", "goal"), True)
    if not squared:
        out = out.withColumn("distance", F.sqrt("distance"))
    out = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    # One row a query until the end: k rows of each would be shuffled otherwise.
    hits = out.groupBy(F.col("query_id").alias("of")).agg(F.collect_list(F.struct("doc_id", "distance", "rank")).alias("hits"))
    return asked.select("query_id", "of").join(shuffled(hits), "of").select("query_id", "hits.doc_id", "hits.distance", "hits.rank")


def _asked(q: DataFrame, apart: bool) -> DataFrame:
    """(query_id, of, vs), written: a query's vectors, but null where they are those of ``of``, the smallest id with the
    same ones (itself if ``apart``), as equal queries have equal neighbours."""
    spark = q.sparkSession
    path = shared_path(spark, "vector-queries")
    q.write.parquet(f"{path}/given")  # embedded once
    q = spark.read.schema(q.schema).parquet(f"{path}/given").where("query_id is not null")
    q = q.groupBy("query_id").agg(F.array_sort(F.collect_list("v")).alias("vs")).where(F.size("vs") > 0)
    if apart:
        q = q.withColumn("of", F.col("query_id"))
    else:
        same = Window.partitionBy(F.xxhash64("vs"), F.xxhash64(F.lit(1), "vs"))
        q = q.withColumn("of", F.min("query_id").over(same))
    rows = q.select("query_id", "of", F.when(F.col("query_id") == F.col("of"), F.col("vs")).alias("vs"))
    rows.write.parquet(f"{path}/asked")
    return spark.read.schema(rows.schema).parquet(f"{path}/asked")


def search_text(texts: DataFrame, k: int, index: VectorIndex, embed, qid: str = "query_id", text_col: str = "text") -> DataFrame:
    """(query_id, doc_id, distance, rank) of the k rows nearest to each text; ``embed`` is Column -> Column."""
    # Dealt by id first: one unsplit file is still embedded by many tasks.
    rows = texts.select(F.col(qid).alias("query_id"), F.col(text_col).alias("text")).repartition("query_id")
    return knn(rows.select("query_id", embed(F.col("text")).alias("embedding")), None, k, index=index)


def knn_lsh(queries: DataFrame, catalog: DataFrame, k: int, qid: str = "query_id", cid: str = "doc_id",
            qvec: str = "embedding", cvec: str = "embedding", bucket_length: float = 0.5, num_tables: int = 8,
            seed: int = 7, exclude_self: bool = False) -> DataFrame:
    """R5 approximate: bucketed random projection LSH join (equi-join on hash buckets), then top-k.

    Returns squared distances like :func:`knn`, of rows that share a bucket in at least one table; a query may
    get fewer than k.  Recall against the exact form is tested.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    q = queries.select(F.col(qid).alias("qid"), array_to_vector(to_double_array(qvec)).alias("features")).where("qid is not null and features is not null")
    c = catalog.select(F.col(cid).alias("cid"), array_to_vector(to_double_array(cvec)).alias("features")).where("cid is not null and features is not null")
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                      numHashTables=num_tables, seed=seed).fit(c)
    pairs = lsh.approxSimilarityJoin(q, c, float("inf"), distCol="dist").select(
        F.col("datasetA.qid").alias("query_id"), F.col("datasetB.cid").alias("doc_id"),
        (F.col("dist") * F.col("dist")).alias("distance"))
    if exclude_self:
        pairs = pairs.filter(F.col("query_id") != F.col("doc_id"))
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 9).asc(), F.col("doc_id").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def embed_with(df: DataFrame, text_col: str, out_col: str, model_factory, dim: int, batch_rows: int = 256) -> DataFrame:
    """R4 with a pluggable model: ``model_factory()`` is called in each task (a ``parts.Model`` loads once per worker) and must return
    ``encode(list[str]) -> np.ndarray[n, dim]``.  Arrow batches keep the transfer vectorised."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def run(it):
        encode = model_factory()
        for pdf in it:
            texts = pdf[text_col].fillna("").astype(str).tolist()
            vecs = []
            for s in range(0, len(texts), batch_rows):
                vecs.extend(np.asarray(encode(texts[s:s + batch_rows]), dtype=np.float64).tolist())
            pdf[out_col] = vecs
            yield pdf

    return df.mapInPandas(run, schema)
