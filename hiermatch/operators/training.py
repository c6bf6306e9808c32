"""Training-data mining (G1-G6) with deterministic, partition-independent sampling.

Sampling without pairing every query with its whole pool: rows of each pool
(family, segment or the whole catalog) get a dense position in a seeded md5
order; each query takes the rows at consecutive cyclic positions starting at
its own md5 offset, skipping rows that carry its truth name.  Neighbouring rows
of one name are one run, and neighbouring runs differ in name, so the runs a
query must skip are at most every other one: it looks up 2n + 3 runs and then n
rows, however many rows carry its truth name.  The sample is one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, join_key
from ..session import cut_lineage, shuffled
from .position import row_position

SEED = "hiermatch"
#: Hex digits of the order's md5 that number the parts of a group.
HASH_DIGITS = 3


def md5_order(seed: str, *cols) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in cols]))


def md5_offset(seed: str, col: str, modulus: Column) -> Column:
    """First 8 hex digits of md5(seed|col) as a number, modulo ``modulus``."""
    h = F.conv(F.substring(md5_order(seed, col), 1, 8), 16, 10).cast("long")
    return F.pmod(h, modulus)


def dense_positions(df: DataFrame, group_col: str, order_cols: list, partitions: int | None = None) -> DataFrame:
    """0-based position of each row inside its group under ``order_cols`` (a total order).

    No window over the group: rows are range-partitioned on (group, order), numbered
    inside each partition, and per-(partition, group) offsets are added.  A hot group is
    spread over many partitions instead of landing in one task.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group_col)] + [F.col(c) for c in order_cols]
    s = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Read twice below: cut lineage so both reads see the same ids even after executor loss.
    s = cut_lineage(s)
    counts = s.groupBy("_pid", group_col).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return (
        s.join(offsets.select("_pid", group_col, "_first", "_off"), ["_pid", group_col])
        .withColumn("pos", (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
        .drop("_pid", "_mid", "_first", "_off")
    )


def hashed_positions(df: DataFrame, group_col: str, hash_col: str, ties: list[str]) -> DataFrame:
    """``pos``, the 0-based position of each row inside its group in the order of ``hash_col`` (hex digits) and
    ``ties``, and ``group_size``; a lazy plan.

    Rows are numbered inside (group, first hex digits); the counts of at most 16 ** HASH_DIGITS such parts of a
    group give each part its first position.  A hash deals a group's rows evenly, so a hot group is spread.
    """
    parts = df.withColumn("_part", F.substring(hash_col, 1, HASH_DIGITS))
    group = Window.partitionBy(group_col)
    sizes = parts.groupBy(group_col, "_part").agg(F.count(F.lit(1)).alias("_n"))
    firsts = sizes.select(group_col, "_part", (F.sum("_n").over(group.orderBy("_part")) - F.col("_n")).alias("_before"),
                          F.sum("_n").over(group).alias("group_size"))
    nth = F.row_number().over(Window.partitionBy(group_col, "_part").orderBy(hash_col, *ties)) - 1
    return parts.withColumn("_nth", nth).join(shuffled(firsts), [group_col, "_part"]).withColumn(
        "pos", F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_before")


def name_runs(pool: DataFrame, group_col: str, block: int = 4096) -> DataFrame:
    """(group, pos, name_key, run, n_runs): the 0-based number of the run of neighbouring rows with one name that
    each row is in, and the number of runs of its group.

    Changes of name are counted inside blocks of ``block`` positions; one row per block carries them on.
    """
    inside = Window.partitionBy(group_col, "_block").orderBy("pos")
    rows = pool.select(group_col, "pos", "name_key").withColumn("_block", F.floor(F.col("pos") / block))
    changes = ~F.lag(F.struct("name_key")).over(inside).eqNullSafe(F.struct("name_key")) & (F.row_number().over(inside) > 1)
    rows = rows.withColumn("_new", changes.cast("long"))
    blocks = rows.groupBy(group_col, "_block").agg(
        F.sum("_new").alias("_inner"), F.min_by(F.struct("name_key"), "pos").alias("_head"), F.max_by(F.struct("name_key"), "pos").alias("_tail"))
    along = Window.partitionBy(group_col).orderBy("_block")
    blocks = blocks.withColumn("_opens", (~F.lag("_tail").over(along).eqNullSafe(F.col("_head"))).cast("long"))
    blocks = blocks.select(
        group_col, "_block", (F.sum(F.col("_inner") + F.col("_opens")).over(along) - F.col("_inner") - 1).alias("_first"),
        F.sum(F.col("_inner") + F.col("_opens")).over(Window.partitionBy(group_col)).alias("n_runs"))
    return rows.withColumn("_nth", F.sum("_new").over(inside)).join(shuffled(blocks), [group_col, "_block"]).select(
        group_col, "pos", "name_key", (F.col("_first") + F.col("_nth")).alias("run"), "n_runs")


def cyclic_sample(queries: DataFrame, pool: DataFrame, group_col: str, n: int, seed: str = SEED,
                  single_group: bool = False) -> DataFrame:
    """Up to ``n`` pool rows per query from the query's group, skipping the query's own name.

    ``queries``: (query_id, <group_col>, truth_key), ids distinct; ``pool``: (<group_col>, pos, group_size,
    name_key, ...payload).  Returns the query columns plus the pool payload and ``pick`` (1..n).
    A group with fewer rows of other names gives all of them; an unknown or null group gives none.
    """
    sizes = pool.groupBy(group_col).agg(F.max("group_size").alias("group_size"))
    if single_group:
        # One group (the whole pool): the size table has exactly one row, so attach it by
        # broadcast; a constant join key would otherwise let the planner pick either side.
        q = queries.drop(group_col).crossJoin(F.broadcast(sizes))
    else:
        q = queries.join(shuffled(sizes), group_col)
    q = q.select("query_id", group_col, "truth_key", md5_offset(seed, "query_id", F.col("group_size")).alias("offset"))
    rows = name_runs(pool, group_col)
    runs = rows.groupBy(group_col, "run").agg(
        F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.min_by(F.struct("name_key"), "pos").alias("_name"))
    # The run that the offset lies in comes first, from the offset on, and again last, up to the offset, if all
    # runs are read.  Only where positions start anew may two neighbours share a name, so of 2n + 3 runs at least
    # n + 1 carry another name than the truth.
    first = rows.select(group_col, F.col("pos").alias("offset"), F.col("run").alias("_run"), "n_runs")
    ahead = q.join(shuffled(first), [group_col, "offset"]).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(2 * n + 2), F.col("n_runs")))))
    ahead = ahead.withColumn("run", F.pmod(F.col("_run") + F.col("i"), F.col("n_runs"))).join(shuffled(runs), [group_col, "run"])
    begin = F.when(F.col("i") == 0, F.col("offset")).otherwise(F.col("start"))
    end = F.when((F.col("i") > 0) & (F.col("i") == F.col("n_runs")), F.col("offset")).otherwise(F.col("end"))
    ahead = ahead.where(~F.col("_name.name_key").eqNullSafe(F.col("truth_key"))).select(
        "query_id", group_col, "i", begin.alias("begin"), F.least(F.lit(n), end - begin).alias("size")).where("size > 0")
    before = F.sum("size").over(Window.partitionBy("query_id").orderBy("i")) - F.col("size")
    ahead = ahead.withColumn("before", before).where(F.col("before") < n)
    picks = ahead.select("query_id", group_col, "begin", "before", F.explode(
        F.sequence(F.lit(0).cast("long"), F.least(F.col("size"), n - F.col("before")) - 1)).alias("k"))
    picks = picks.select("query_id", group_col, (F.col("begin") + F.col("k")).alias("pos"), (F.col("before") + F.col("k") + 1).alias("pick"))
    picks = picks.join(shuffled(pool.drop("group_size")), [group_col, "pos"]).drop("pos", group_col)
    return queries.join(shuffled(picks), "query_id")


def name_to_corpus(catalog: DataFrame, pos_col: str | None = None) -> DataFrame:
    """G1: strip+lower name -> corpus, last row wins."""
    return catalog.groupBy(join_key("commodity_name").alias("truth_key")).agg(
        F.max_by("corpus", row_position(catalog, pos_col)).alias("positive"))


def first_row_levels(catalog: DataFrame, pos_col: str | None = None) -> DataFrame:
    """Positive's segment/family: first catalog row whose lower-cased (unstripped) name matches."""
    return catalog.groupBy(F.lower("commodity_name").alias("truth_key")).agg(
        F.min_by(F.struct("segment_name", "family_name"), row_position(catalog, pos_col)).alias("lv")
    ).select("truth_key", F.col("lv.segment_name").alias("true_segment"), F.col("lv.family_name").alias("true_family"))


def _pool(catalog: DataFrame, group_col: str, seed: str) -> DataFrame:
    c = catalog.select(
        F.col(group_col).alias("grp"), "commodity_code", F.lower("commodity_name").alias("name_key"),
        F.col("corpus").alias("neg_corpus"), md5_order(seed, "commodity_code").alias("_h"), F.xxhash64("corpus").alias("_tie"))
    # Rows that tie in everything but the text are told apart by its hash: the plan is read more than once.
    return hashed_positions(c.filter(F.col("grp").isNotNull()), "grp", "_h", ["commodity_code", "name_key", "_tie"]).drop("_h", "_tie")


def _queries(queries: DataFrame, catalog: DataFrame, qtext: str, qlabel: str) -> DataFrame:
    q = queries.select("query_id", F.col(qtext).alias("query_text"), join_key(qlabel).alias("truth_key"))
    return q.join(shuffled(name_to_corpus(catalog)), "truth_key").filter(
        F.col("positive").isNotNull() & (F.col("positive") != ""))


def hard_triples(queries: DataFrame, catalog: DataFrame, n: int = 5, seed: str = SEED,
                 qtext: str = "search_query", qlabel: str = "commodity_name") -> DataFrame:
    """G2 + G3: (query, positive, negative, positive_commodity, negative_commodity).

    Negatives come from the positive's family; when it holds fewer than ``n`` other names,
    min(n, available) come from its segment instead.
    """
    q = _queries(queries, catalog, qtext, qlabel).join(shuffled(first_row_levels(catalog)), "truth_key")
    fam_pool = _pool(catalog, "family_name", seed)
    seg_pool = _pool(catalog, "segment_name", seed)
    fam_avail = fam_pool.groupBy("grp", "name_key").agg(F.count(F.lit(1)).alias("_c"))
    fam_size = fam_pool.select("grp", "group_size").distinct()
    qf = (q.withColumn("grp", F.col("true_family"))
          .join(shuffled(fam_size), "grp", "left")
          .join(shuffled(fam_avail.withColumnRenamed("name_key", "truth_key")), ["grp", "truth_key"], "left")
          .withColumn("fam_others", F.coalesce("group_size", F.lit(0)) - F.coalesce("_c", F.lit(0)))
          .drop("group_size", "_c"))
    by_family = qf.filter(F.col("fam_others") >= n).drop("fam_others")
    by_segment = qf.filter(F.col("fam_others") < n).drop("fam_others").withColumn("grp", F.col("true_segment"))
    cols = ["query_id", "grp", "truth_key", "query_text", "positive"]
    picks = cyclic_sample(by_family.select(*cols), fam_pool, "grp", n, seed).unionByName(
        cyclic_sample(by_segment.select(*cols), seg_pool, "grp", n, seed))
    return picks.select(
        "query_id",
        clean("query_text").alias("query"),
        "positive",
        F.col("neg_corpus").alias("negative"),
        F.col("truth_key").alias("positive_commodity"),
        F.col("name_key").alias("negative_commodity"),
        "pick",
    )


def labelled_pairs(queries: DataFrame, catalog: DataFrame, n: int = 5, seed: str = SEED,
                   qtext: str = "search_query", qlabel: str = "commodity_name") -> DataFrame:
    """One positive and up to ``n`` random negatives (lower name != truth) per query."""
    q = _queries(queries, catalog, qtext, qlabel).withColumn("grp", F.lit("*"))
    pool = _pool(catalog.withColumn("_all", F.lit("*")), "_all", seed)
    pos = q.select("query_id", clean("query_text").alias("query"), F.col("positive").alias("document"),
                   F.lit(1).alias("label"), F.col("truth_key").alias("commodity"), F.lit(0).alias("pick"))
    neg = cyclic_sample(q.select("query_id", "grp", "truth_key", "query_text"), pool, "grp", n, seed,
                        single_group=True).select(
        "query_id", clean("query_text").alias("query"), F.col("neg_corpus").alias("document"),
        F.lit(0).alias("label"), F.col("name_key").alias("commodity"), "pick")
    return pos.unionByName(neg)


def mined_triplets(hits: DataFrame, queries: DataFrame, n: int = 5, qtext: str = "search_query",
                   qlabel: str = "commodity_name") -> DataFrame:
    """Per distinct (query, positive name): first ``n`` distinct retrieved texts whose name differs.

    ``hits``: (query_id, rank, corpus, commodity_name) from a top-k search.  Queries without any
    negative are dropped.
    """
    q = queries.select("query_id", F.col(qtext).alias("query"), F.col(qlabel).alias("positive"))
    h = hits.join(shuffled(q), "query_id").filter(~join_key("commodity_name").eqNullSafe(join_key("positive")))
    first_seen = h.groupBy("query", "positive", "corpus").agg(F.min("rank").alias("_r"))
    w = Window.partitionBy("query", "positive").orderBy("_r", "corpus")
    top = first_seen.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= n)
    return top.groupBy("query", "positive").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "corpus"))), lambda s: s["corpus"]).alias("negatives"))


def query_groups(queries: DataFrame, qtext: str = "search_query", qlabel: str = "commodity_name") -> DataFrame:
    """Distinct (query, label) groups with their size."""
    return queries.groupBy(F.col(qtext).alias("query"), F.col(qlabel).alias("label")).agg(
        F.count(F.lit(1)).alias("size"))
