"""Exact deduplication by content sort, DataFrame functions only.

Sampled splitters range-partition the texts, an external sort places equal texts next to each other, and a
window that closes wherever two neighbours' full texts differ keeps one row of each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: A text is hot if its copies hold over 1/HOT_PARTS of a shuffle partition's share of all bytes, so at most
#: HOT_PARTS x spark.sql.shuffle.partitions texts are hot.
HOT_PARTS = 8
#: The least bytes of one text, copies together, that are worth more than one run.
RUN_BYTES = 1 << 20
#: Characters of a text in the sort key; a digest and then the whole text follow.  The splitters sampled to
#: the driver are this short however long the texts are.
LEAD = 64


def _order(col: str, keep: str) -> Column:
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    return F.col(col).asc_nulls_last() if keep == "min" else F.col(col).desc_nulls_last()


def _runs(rows: DataFrame, keep: str, salts: int, run_bytes: int | None = None) -> DataFrame:
    """``rows`` (doc_id, text, ...) with digest, hot, salt, and per run of equal (text, salt) the place of
    the row (nth), the first id (head) and the number of rows (size).

    A text whose copies hold more than ``run_bytes`` is hot and dealt over as many runs as hold that much each, at least ``salts``.
    """
    spark = rows.sparkSession
    bytes_of = F.octet_length("text") + 64
    if run_bytes is None:
        parts = HOT_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
        run_bytes = max(RUN_BYTES, (rows.agg(F.sum(bytes_of)).first()[0] or 0) // parts)
    # The input partition tells apart rows that are equal in every column, and does not change when a lost task is
    # run again, as the order of rows within a partition may.
    rows = rows.withColumn("place", F.spark_partition_id()).withColumn("digest", F.unhex(F.sha2("text", 256)))
    hot = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.sum(bytes_of).alias("bytes")).where((F.col("n") > 1) & (F.col("bytes") > run_bytes))
    hot = save(hot.select(F.col("digest").alias("hot_digest"), F.greatest(F.lit(salts).cast("long"), F.ceil(F.col("bytes") / run_bytes)).alias("salts")), "exact-hot")
    if hot.isEmpty():
        rows = rows.withColumns({"hot": F.lit(False), "salts": F.lit(1).cast("long")})
    else:
        rows = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left").withColumn("hot", F.col("hot_digest").isNotNull())
    # Never a constant, also without a hot text: the planner would drop the salt from the window but not from
    # the range partitioning, and exchange the rows once more.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), F.coalesce("salts", F.lit(1))).cast("int"))
    rows = rows.withColumn("lead", F.substring("text", 1, LEAD)).drop("hot_digest", "salts", "place")
    key = ["text", "lead", "digest", "salt"]
    by_range = rows.repartitionByRange("lead", "digest", "salt").sortWithinPartitions(*key, _order("doc_id", keep))
    run = Window.partitionBy(*key)  # the range partitioning already holds each run together: no exchange
    return (
        by_range.withColumn("nth", F.row_number().over(run.orderBy(_order("doc_id", keep))))
        .withColumn("head", F.first("doc_id").over(run.orderBy(_order("doc_id", keep))))
        .withColumn("size", F.count(F.lit(1)).over(run))
        .drop("lead")
    )


def _heads(runs: DataFrame, keep: str) -> DataFrame:
    """First rows of the runs of hot texts, at most twice as many as runs of ``run_bytes`` fit into all rows, with
    the first id and the rows of their whole group; wins marks the run whose first row is the group's."""
    group = Window.partitionBy("text")
    nth = F.row_number().over(group.orderBy(_order("head", keep), "salt"))
    return runs.where("hot and nth = 1").select(
        "digest", "salt", "head", F.first("head").over(group.orderBy(_order("head", keep), "salt")).alias("group_head"),
        F.sum("size").over(group).alias("group_size"), (nth == 1).alias("wins"))


def _same_run() -> Column:
    return ((F.col("r.digest") == F.col("h.digest")) & (F.col("r.salt") == F.col("h.salt"))
            & F.col("r.head").eqNullSafe(F.col("h.head")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                normalise=None, salts: int = 2, run_bytes: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalise`` (Column -> Column, default none).  Of equal texts
    the row with the smallest (``keep='min'``) or largest (``'max'``) id stays.

    Null texts count as empty.  A null id never wins over another id; a group of null ids only has a null
    keep_id.  Rows repeated with one id count singly in group_size, and exactly one of them is kept.  An
    empty table gives an empty result; other columns are ignored.

    A text whose copies hold over ``run_bytes`` (default: 1/HOT_PARTS of a shuffle partition's share of all bytes,
    at least RUN_BYTES) is dealt over runs of about that size (at least ``salts``) by a hash of the id and of the input partition, so
    also copies with null or repeated ids.  Only the first row of each such run meets the others again,
    compared by its full text.
    """
    text = F.col(text_col) if normalise is None else normalise(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    runs = _runs(rows, keep, salts, run_bytes).withColumn("text", F.when(F.col("hot") & (F.col("nth") == 1), F.col("text")))
    runs = save(runs, "exact-runs")
    out = runs.drop("text").alias("r").join(F.broadcast(_heads(runs, keep).alias("h")), F.col("r.hot") & _same_run(), "left")
    return out.select(
        F.col("r.doc_id").alias("doc_id"),
        F.when(F.col("r.hot"), F.col("h.group_head")).otherwise(F.col("r.head")).alias("keep_id"),
        F.when(F.col("r.hot"), F.col("h.group_size")).otherwise(F.col("r.size")).alias("group_size"),
        ((F.col("r.nth") == 1) & F.coalesce(F.col("h.wins"), F.lit(True))).alias("kept"),
        F.lower(F.hex(F.col("r.digest"))).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", salts: int = 2, run_bytes: int | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns; the rows travel with
    their text through the one range exchange, so no join brings them back."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.col(text_col).isNull().alias("null of " + text_col)).alias("rest"))
    first = save(_runs(rows, keep, salts, run_bytes).where("nth = 1"), "exact-first")
    lost = _heads(first, keep).where("not wins")
    out = first.alias("r").join(F.broadcast(lost.alias("h")), F.col("r.hot") & _same_run(), "left_anti")
    return out.select(*[F.when(~F.col("r.rest")["null of " + text_col], F.col("r.text")).alias(c) if c == text_col
                        else F.col("r.rest")[c].alias(c) for c in docs.columns])
