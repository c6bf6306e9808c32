"""Packing: optimal length buckets by dynamic programming over the global length histogram."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import save
from .wordhash import chunks, words

#: Full batches per shard of a bucket, at least about this many: one batch of a shard may stay part-filled.
SHARD_BATCHES = 64


def boundaries(lengths, counts, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise sum(bound - length) over all rows.

    Ties go to the cut with the smallest lower bucket.  Exact: least[b][j] is the cost of the first j
    lengths in b buckets, the last of which has lengths[j - 1] as its bound.  The best cut never moves down
    as j grows (the cost satisfies the quadrangle inequality), so the middle j bounds the cuts on both its sides:
    n log n costs a bucket in place of n^2 / 2.
    """
    at = np.argsort(lengths)
    x, c = np.asarray(lengths, np.int64)[at], np.asarray(counts, np.int64)[at]
    if not len(x):
        return []
    below = np.r_[0, np.cumsum(c)]
    n, k = len(x), min(buckets, len(x))
    least, cut = np.full((k + 1, n + 1), np.inf), np.zeros((k + 1, n + 1), np.int64)
    least[0, 0] = 0
    for b in range(1, k + 1):
        todo = [(b, n, b - 1, n - 1)]  # lengths from .. to, whose best cuts lie in low .. high
        while todo:
            lo, hi, low, high = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            to = min(j, high + 1)
            cost = least[b - 1, low:to] + float(x[j - 1]) * (below[j] - below[low:to])
            i = int(np.argmin(cost))
            least[b, j], cut[b, j] = cost[i], i + low
            todo += [(lo, j - 1, low, i + low), (j + 1, hi, i + low, high)]
    j, out = n, []
    for b in range(int(np.argmin(least[1:, n])) + 1, 0, -1):
        out.append(int(x[j - 1]))
        j = int(cut[b, j])
    return out[::-1]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length): number of words between ASCII blanks; 0 for null."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part, buf, off in chunks(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(words(buf, off)[2]))], names=["doc_id", "length"])

    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, length long")


def pack(docs: DataFrame, budget: int = 8192, buckets: int = 8, length: Column | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, length, bucket, bound, shard, batch, place, padding.

    ``length`` is a column of token counts (default: words between ASCII blanks).  The histogram of all
    lengths up to ``budget`` (so at most budget + 1 of them) is cut into at most ``buckets`` ranges that
    minimise total padding.  A batch is the rows with one (bucket, shard, batch): each is padded to the
    bucket's bound, and as many are taken as the budget holds.  Buckets are dealt by a hash of the id into
    shards that grow in number with the bucket.  Rows with one id and length are counted before they are dealt and
    go in pieces to shards that follow one another, so no group is unbounded however often an id is repeated.

    A row longer than the budget is never cut: it is a batch of its own, in bucket -1 with its own length as
    bound.  Null and empty texts have length 0 and a null length counts as 0.  Null ids and repeated rows are
    packed like other rows; ties are broken by id and then length.  An empty table gives an empty result;
    other columns are ignored.
    """
    if length is None:
        rows = word_counts(docs, id_col, text_col)
    else:
        rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("length"))
    rows = save(rows, "pack-lengths")
    seen = rows.groupBy(F.when(F.col("length") <= budget, F.col("length")).alias("length")).count().collect()
    bounds = boundaries([r.length for r in seen if r.length is not None], [r["count"] for r in seen if r.length is not None], buckets)
    sizes = [sum(r["count"] for r in seen if r.length is not None and lo < r.length <= hi) for lo, hi in zip([-1, *bounds], bounds)]
    over = sum(r["count"] for r in seen if r.length is None)

    bucket, bound, per, shards = F.lit(-1), F.col("length"), F.lit(1), F.lit(1 + over // SHARD_BATCHES)
    for i in reversed(range(len(bounds))):
        inside, fit = F.col("length") <= bounds[i], budget // max(1, bounds[i])
        bucket, bound = F.when(inside, i).otherwise(bucket), F.when(inside, F.lit(bounds[i]).cast("long")).otherwise(bound)
        per, shards = F.when(inside, fit).otherwise(per), F.when(inside, 1 + sizes[i] // (SHARD_BATCHES * fit)).otherwise(shards)
    rows = rows.groupBy("doc_id", "length").count().select(
        "doc_id", "length", "count", bucket.alias("bucket"), bound.alias("bound"), per.alias("per"), shards.cast("long").alias("shards"))
    whole = F.col("per") * SHARD_BATCHES
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / whole))))
    rows = rows.withColumn("n", F.least(whole.cast("long"), F.col("count") - F.col("piece") * whole))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "length") + F.col("piece"), F.col("shards")))
    before = F.sum("n").over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "length", "piece")) - F.col("n")
    rows = rows.withColumn("before", before).withColumn("nth", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)))
    return rows.select(
        "doc_id", "length", "bucket", "bound", "shard", F.floor(F.col("nth") / F.col("per")).alias("batch"),
        (F.col("nth") % F.col("per")).alias("place"), (F.col("bound") - F.col("length")).alias("padding"))
