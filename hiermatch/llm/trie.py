"""Prefix trie of conversations by fixed-length blocks of turns.

Every conversation is its turns and an end mark, cut into blocks of BLOCK turns.  Conversations that share all
blocks up to some place have the same block prefix: a sum of hashes of (block number, SHA-256 of the block), so that
prefixes come from running sums and not from one round per block.  Conversations are grouped by block prefix first.
Where all members of a prefix go on with the same block, its turns are nodes with the same members; only where
siblings diverge are turn boundaries refined, over distinct blocks and not over conversations.

A node's conversation is its smallest member.  A conversation that is a node's smallest member stays that further
down, so what subtrees sum up is a sum over members, less what lies above on the node's own conversation.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.training import dense_positions
from .common import save

#: Turns of a block: 2^2.
BLOCK_BITS = 2
#: Rows that one window or one piece holds: 2^12.
PART_BITS = 12
_LANES = ["l0", "l1", "l2", "l3"]
_END = "end"


def running_sums(df: DataFrame, group: str, at: str, cols: list[str]) -> DataFrame:
    """``df`` with every column of ``cols`` replaced by its sum over the rows of ``group`` up to ``at`` (unique in it).

    A window holds a group's rows of one range of 2^12 places; what comes before is added from the ranges' sums.
    """
    df = df.withColumn("_part", F.shiftright(at, PART_BITS))
    sums = df.groupBy(group, "_part").agg(*(F.sum(c).alias(f"_{c}") for c in cols))
    before = Window.partitionBy(group).orderBy("_part")
    up_to = before.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_part", F.row_number().over(before).alias("_nth"), *(F.sum(f"_{c}").over(up_to).alias(f"_{c}") for c in cols)).where("_nth > 1").drop("_nth")
    inside = Window.partitionBy(group, "_part").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    run = df.select(*(F.sum(c).over(inside).alias(c) if c in cols else F.col(c) for c in df.columns)).join(sums, [group, "_part"], "left")
    return run.select(*((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) if c in cols else F.col(c) for c in df.columns if c != "_part"))


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, key, words): turns in order from 0; ``key`` stands for role and text, ``words`` counts the text's words.

    Order is by turn (null first), role, the text's first 64 characters and ``key``.  Null role or text is empty.
    Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("key"),
                       F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return dense_positions(rows, "conv_id", ["turn", "role", "head", "key"]).select("conv_id", "pos", "key", "words")


def share_openings(rows: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after giving each conversation c the first crc32(c) % ``most`` turns of conversation
    c - c % ``every`` in place of its own first ones; ``rows`` are from :func:`numbered`.

    Conversations left without turns are in the second table only, which has (conv_id, n_turns).
    """
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = sizes.select("conv_id", "own", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = save(convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")), "trie-convs")
    own = rows.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    lent = rows.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base").join(convs, "base").where("pos < h")
    return own.unionByName(lent.select("conv_id", "pos", "key", "words")), convs.select("conv_id", "n_turns")


def _blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, block, items, before, upto, ended): blocks with the prefixes before and up to them."""
    marks = convs.select("conv_id", F.col("n_turns").alias("pos"), F.lit(_END).alias("key"), F.lit(0).cast("long").alias("words"))
    rows = turns.select("conv_id", F.col("pos").cast("long").alias("pos"), "key", "words").unionByName(marks.withColumn("pos", F.col("pos").cast("long")))
    blocks = rows.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("items"))
    digest = F.sha2(F.array_join(F.transform("items", lambda x: x["key"]), ","), 256)
    lane = lambda k: F.xxhash64(F.lit(k), "block", "digest").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    own = blocks.withColumn("digest", digest).select("conv_id", "block", "items", *(lane(k).alias(c) for k, c in enumerate(_LANES)), *(lane(k).alias(f"own_{c}") for k, c in enumerate(_LANES)))
    run = running_sums(own, "conv_id", "block", _LANES)
    return run.select("conv_id", "block", "items", F.concat_ws(".", *(F.col(c) - F.col(f"own_{c}") for c in _LANES)).alias("before"),
                      F.concat_ws(".", *_LANES).alias("upto"), (F.element_at("items", -1)["key"] == _END).alias("ended"))


def _refined(groups: DataFrame, *aggs) -> DataFrame:
    """Turn boundaries inside blocks where siblings diverge: one row per (block, before, place, its turns so far)."""
    keys = F.transform("items", lambda x: x["key"])
    so_far = lambda n: F.sha2(F.array_join(F.slice("ks", 1, n), ","), 256)
    rows = groups.where("kids > 1").withColumn("ks", keys).select("*", F.posexplode("items").alias("j", "item"))
    rows = rows.withColumn("here", so_far(F.col("j") + 1)).withColumn("above", so_far(F.col("j")))
    return rows.groupBy("block", "before", "j", "here", "above").agg(F.min("rep").alias("rep"), F.first("item.pos").alias("pos"), *aggs)


def _members_digest(blocks: DataFrame) -> DataFrame:
    """(first, ends_sha256) of each set of equal conversations: SHA-256 of the ascending ids, comma-joined.

    Ids are sorted in ranges and joined in pieces of at most 2^12, so a task reads pieces and not a large set's rows.
    """
    rows = blocks.where("ended").select("upto", "conv_id")
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartitionByRange(n, "upto", "conv_id").sortWithinPartitions("upto", "conv_id").withColumn("gid", F.monotonically_increasing_id())
    runs = save(runs, "trie-ends")
    pieces = runs.groupBy("upto", F.shiftright("gid", PART_BITS).alias("piece")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("upto", "piece", F.col("ids")[0].alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    id_type = pieces.schema["first"].dataType
    arrow = to_arrow_type(id_type)

    def run(batches):
        last = first = digest = None
        for batch in batches:
            out = []
            for key, at, ids in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if key != last:
                    if digest:
                        out.append((first, digest.hexdigest()))
                    last, first, digest = key, at, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], arrow), pa.array([d for _, d in out], pa.string())], ["first", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([first], arrow), pa.array([digest.hexdigest()], pa.string())], ["first", "ends_sha256"])

    return pieces.repartition("upto").sortWithinPartitions("upto", "piece").mapInArrow(run, f"first {id_type.simpleString()}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, from the root (depth 0): conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` is (conv_id, pos, key, words) with places from 0 without gaps, as :func:`numbered` gives; ``convs`` is
    (conv_id, n_turns) and may hold conversations without turns.  ``saved_tokens`` sums (n_convs - 1) x words over the
    subtree; ``ends_sha256`` is of the decimal ids of the conversations that end at the node.  Without conversations there is no row.
    """
    blocks = save(_blocks(turns, convs), "trie-blocks")
    groups = blocks.groupBy("block", "before", "upto").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("rep"), F.first("items").alias("items"))
    groups = save(groups, "trie-groups")
    above = groups.groupBy("block", "before").agg(F.count(F.lit(1)).alias("kids"), F.min("rep").alias("top"))
    groups = save(groups.join(above, ["block", "before"]), "trie-siblings")
    # nodes, those of end marks too
    straight = groups.where("kids = 1").select("rep", "n", F.explode("items").alias("item"))
    straight = straight.select("rep", (F.col("item.pos") + 1).alias("depth"), "n", "item.words", (F.col("item.key") == _END).alias("mark"), F.col("rep").alias("parent"))
    fine = save(_refined(groups, F.sum("n").alias("n"), F.first("item.words").alias("words"), F.first("item.key").alias("key"), F.first("top").alias("top")), "trie-refined")
    upper = fine.select("block", "before", (F.col("j") + 1).alias("j"), F.col("here").alias("above"), F.col("rep").alias("parent"))
    cols = ["rep", (F.col("pos") + 1).alias("depth"), "n", "words", (F.col("key") == _END).alias("mark"), "parent"]
    nodes = straight.unionByName(fine.where("j = 0").withColumn("parent", F.col("top")).select(*cols))
    nodes = nodes.unionByName(fine.where("j > 0").join(upper, ["block", "before", "j", "above"]).select(*cols))
    none = F.lit(None)
    root = convs.agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        "rep", F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("words"), F.lit(False).alias("mark"), none.cast(convs.schema["conv_id"].dataType).alias("parent"))
    nodes = save(nodes.unionByName(root), "trie-nodes")
    under = nodes.where("parent is not null").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.sum((~F.col("mark")).cast("long")).alias("n_children"), F.min(F.when(F.col("mark"), F.col("rep"))).alias("first"))
    nodes = nodes.where("not mark").join(under, ["rep", "depth"], "left").withColumn("saved", (F.col("n") - 1) * F.col("words"))
    nodes = save(nodes, "trie-counted")
    # what each conversation adds to every node it is a member of
    adds = nodes.groupBy("rep").agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")).withColumnRenamed("rep", "conv_id")
    adds = save(adds, "trie-adds")
    sums = blocks.select("conv_id", "block", "before", "upto").join(adds, "conv_id").groupBy("block", "before", "upto").agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves"))
    groups = groups.join(sums, ["block", "before", "upto"])
    total = [F.sum("all_saved").alias("all_saved"), F.sum("n_leaves").alias("n_leaves")]
    sums = groups.where("kids = 1").select("rep", F.explode("items").alias("item"), "all_saved", "n_leaves").select("rep", (F.col("item.pos") + 1).alias("depth"), "all_saved", "n_leaves")
    sums = sums.unionByName(_refined(groups, *total).select("rep", (F.col("pos") + 1).alias("depth"), "all_saved", "n_leaves"))
    sums = sums.unionByName(adds.agg(F.min("conv_id").alias("rep"), F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves")).where("rep is not null").withColumn("depth", F.lit(0).cast("long")))
    shared = nodes.where("n > 1").select("rep", "depth", "saved", F.col("saved").alias("own"))
    shared = running_sums(shared, "rep", "depth", ["saved"]).select("rep", "depth", (F.col("saved") - F.col("own")).alias("over"))
    out = nodes.join(sums, ["rep", "depth"]).join(shared, ["rep", "depth"], "left").join(_members_digest(blocks), "first", "left")
    return out.select(F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
                      F.when(F.col("n") > 1, F.col("all_saved") - F.col("over")).otherwise(0).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
