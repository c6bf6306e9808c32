"""Taxonomy operators (H1-H9).

The hierarchy is keyed by *name*, like the reference: a family name that
occurs under two segments links both segments to all its classes (the
"leak").  ``key='path'`` keys every level by its full path instead.

Closure ("valid commodities") is never materialised per query.  Instead the
static table ``reach(segment, commodity_name)`` is folded once into
``reach_segments(commodity_name, segments)`` — bounded by the number of
segments — and a candidate is in the hierarchy when that array overlaps the
query's evidence segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffled
from .position import row_position

LEVEL_COLS = ("segment_name", "family_name", "class_name", "commodity_name")


def keyed(catalog: DataFrame, key: str = "name") -> DataFrame:
    """Name keys (default) or full-path keys for the four levels."""
    if key == "name":
        return catalog
    sep = F.lit(" > ")
    return catalog.select(
        "commodity_code",
        F.col("segment_name"),
        F.concat_ws(" > ", "segment_name", "family_name").alias("family_name"),
        F.concat(F.col("segment_name"), sep, F.col("family_name"), sep, F.col("class_name")).alias("class_name"),
        F.col("commodity_name"),
    )


def edges(catalog: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """H1: distinct (segment, family), (family, class), (class, commodity) name pairs."""
    sf = catalog.select(F.col("segment_name").alias("parent"), F.col("family_name").alias("child")).distinct()
    fc = catalog.select(F.col("family_name").alias("parent"), F.col("class_name").alias("child")).distinct()
    cc = catalog.select(F.col("class_name").alias("parent"), F.col("commodity_name").alias("child")).distinct()
    return sf, fc, cc


def edge_table(catalog: DataFrame) -> DataFrame:
    """H1 long form: (level, parent, child)."""
    sf, fc, cc = edges(catalog)
    return (
        sf.withColumn("level", F.lit("segment_family"))
        .unionByName(fc.withColumn("level", F.lit("family_class")))
        .unionByName(cc.withColumn("level", F.lit("class_commodity")))
        .select("level", "parent", "child")
    )


def level_counts(catalog: DataFrame) -> DataFrame:
    """H1: node counts per level as the parent-map sizes (distinct non-null names)."""
    return catalog.agg(
        F.count_distinct("segment_name").alias("segments"),
        F.count_distinct("family_name").alias("families"),
        F.count_distinct("class_name").alias("classes"),
        F.count_distinct("commodity_name").alias("commodities"),
    )


def reverse_lookup(catalog: DataFrame, pos_col: str | None = None) -> DataFrame:
    """H2: commodity name -> (segment, family, class), last row wins."""
    pos = row_position(catalog, pos_col)
    h = F.struct("segment_name", "family_name", "class_name")
    return catalog.groupBy("commodity_name").agg(F.max_by(h, pos).alias("h")).select("commodity_name", "h.*")


def reach(catalog: DataFrame) -> DataFrame:
    """H7 static closure: every (segment, commodity name) connected through name-keyed edges.

    Distinct after each hop so the intermediate never exceeds the pair count of one level.
    """
    sf, fc, cc = edges(catalog)
    seg_cls = (
        sf.join(shuffled(fc.withColumnRenamed("parent", "child_f").withColumnRenamed("child", "cls")),
                F.col("child") == F.col("child_f"))
        .select(F.col("parent").alias("segment_name"), "cls").distinct()
    )
    return (
        shuffled(seg_cls).join(cc, seg_cls["cls"] == cc["parent"])
        .select("segment_name", F.col("child").alias("commodity_name"))
        .distinct()
    )


def reach_segments(catalog: DataFrame) -> DataFrame:
    """Per commodity name, the sorted segments whose closure contains it (bounded by #segments)."""
    return reach(catalog).groupBy("commodity_name").agg(F.array_sort(F.collect_set("segment_name")).alias("reach_segments"))


def evidence(cands: DataFrame, top: int = 5, pos_col: str = "cand_pos") -> DataFrame:
    """H3: (query_id, level, name, cnt) over the first ``top`` candidates in fused order; empty names ignored."""
    head = cands.filter(F.col(pos_col) <= top)
    long = head.select(
        "query_id",
        F.explode(F.array(
            F.struct(F.lit("segment").alias("level"), F.col("segment_name").alias("name")),
            F.struct(F.lit("family").alias("level"), F.col("family_name").alias("name")),
            F.struct(F.lit("class").alias("level"), F.col("class_name").alias("name")),
        )).alias("e"),
    ).select("query_id", "e.level", "e.name")
    return (
        long.filter(F.col("name").isNotNull() & (F.col("name") != ""))
        .groupBy("query_id", "level", "name")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def top_segments(ev: DataFrame, n: int = 3) -> DataFrame:
    """H4: top segments by count (ties by name)."""
    w = Window.partitionBy("query_id").orderBy(F.col("cnt").desc(), F.col("name").asc())
    return (
        ev.filter(F.col("level") == "segment")
        .withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= n)
        .select("query_id", F.col("name").alias("segment_name"), "cnt", "rk")
    )


def _top_children(ev: DataFrame, level: str, parent_child: DataFrame, n: int, out_col: str) -> DataFrame:
    """The ``n`` children of *all* evidence segments by evidence count (0 allowed), ties by name.

    The few counted names join their parents, and stay if one is an evidence segment.  A name without a count
    can only be among the first n if fewer than n names under the segments have one, and then it is among
    the n + (number of counted names of the query) smallest names of a segment: so that many are joined in.
    """
    segs = ev.filter(F.col("level") == "segment").select("query_id", F.col("name").alias("parent"))
    counted = ev.filter(F.col("level") == level).select("query_id", F.col("name").alias("child"), "cnt")
    valid = counted.join(parent_child, "child").join(segs, ["query_id", "parent"], "left_semi").select("query_id", "child", "cnt").distinct()
    most = counted.groupBy("query_id").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.max("c"), F.lit(0)).alias("c"))
    w = Window.partitionBy("parent").orderBy(F.col("child").asc())
    named = parent_child.filter(F.col("child").isNotNull()).withColumn("r", F.row_number().over(w))
    small = named.crossJoin(F.broadcast(most)).filter(F.col("r") <= F.col("c") + n).select("parent", "child")
    fill = segs.join(small, "parent").select("query_id", "child").distinct()
    cand = fill.join(valid, ["query_id", "child"], "full").select("query_id", "child", F.coalesce("cnt", F.lit(0)).alias("cnt"))
    rank = Window.partitionBy("query_id").orderBy(F.col("cnt").desc(), F.col("child").asc())
    return (cand.withColumn("rk", F.row_number().over(rank)).filter(F.col("rk") <= n)
            .select("query_id", F.col("child").alias(out_col), "cnt", "rk"))


def top_families(ev: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """H5: families under *all* evidence segments, ranked by evidence count (0 allowed), ties by name."""
    return _top_children(ev, "family", edges(catalog)[0], n, "family_name")


def seg_classes(catalog: DataFrame) -> DataFrame:
    """(segment, class) pairs through name-keyed family edges."""
    sf, fc, _ = edges(catalog)
    return (
        sf.join(fc.withColumnRenamed("parent", "fam").withColumnRenamed("child", "cls"), F.col("child") == F.col("fam"))
        .select(F.col("parent").alias("parent"), F.col("cls").alias("child")).distinct()
    )


def top_classes(ev: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """H6: classes under every valid family (= reachable from the evidence segments), top n."""
    return _top_children(ev, "class", seg_classes(catalog), n, "class_name")


def closure_size(ev: DataFrame, catalog: DataFrame) -> DataFrame:
    """H7: |valid commodities| per query.

    Names are grouped once by the set of segments that reach them; a query's size is the sum over the sets
    that share a segment with its evidence, so no closure is expanded per query.
    """
    sets = (
        ev.filter(F.col("level") == "segment")
        .groupBy("query_id").agg(F.array_sort(F.collect_set("name")).alias("segs"))
    )
    patterns = reach_segments(catalog).groupBy("reach_segments").agg(F.count(F.lit(1)).alias("names"))
    by_segment = patterns.select("names", "reach_segments", F.explode("reach_segments").alias("segment_name"))
    sizes = (
        sets.select("segs").distinct().select("segs", F.explode("segs").alias("segment_name"))
        .join(by_segment, "segment_name").select("segs", "reach_segments", "names").distinct()
        .groupBy("segs").agg(F.sum("names").alias("num_constrained"))
    )
    return sets.join(sizes, "segs", "left").select(
        "query_id", F.coalesce("num_constrained", F.lit(0)).cast("long").alias("num_constrained"))


def evidence_segments(cands: DataFrame, top: int = 5, pos_col: str = "cand_pos") -> DataFrame:
    """Adds ``evidence_segments``: the query's segments among its first ``top`` candidates (window, no shuffle)."""
    w = Window.partitionBy("query_id")
    seg = F.when((F.col(pos_col) <= top) & (F.col("segment_name") != ""), F.col("segment_name"))
    return cands.withColumn("evidence_segments", F.collect_set(seg).over(w))


def boost(cands: DataFrame, factor: float = 1.3, score_col: str = "final_score", multiply: bool = True) -> DataFrame:
    """H8/H9: flag candidates inside the evidence closure, multiply the score by ``factor``.

    Needs ``evidence_segments`` and ``reach_segments`` on each row.
    """
    inside = F.coalesce(F.arrays_overlap(F.col("evidence_segments"), F.col("reach_segments")), F.lit(False))
    out = cands.withColumn("in_hierarchy", inside).withColumn(
        "hierarchy_boost", F.when(inside, F.lit(factor)).otherwise(F.lit(1.0)))
    if multiply:
        out = out.withColumn("boosted_score", F.col(score_col) * F.col("hierarchy_boost"))
    return out
