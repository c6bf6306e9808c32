"""Profiling and validation.

Every profile is one aggregate pass (partial aggregation per partition, one
tiny final stage) returned as a long table via ``unpivot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_key


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _long(wide: DataFrame, value: str) -> DataFrame:
    cols = wide.columns
    return wide.unpivot([], cols, "column_name", value)


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null) — ``df.info()`` as a table."""
    counts = _long(df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]), "non_null")
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, data_type string")
    return counts.join(F.broadcast(types), "column_name").select("column_name", "data_type", "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass."""
    return _long(df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]), "nulls")


def row_digest(df: DataFrame) -> Column:
    """32 bytes that stand for a whole row: SHA-256 of its values as text, each with its length, nulls apart."""
    parts = []
    for c, kind in df.dtypes:
        col = F.col(f"`{c}`")
        if kind in ("float", "double"):
            value = (col + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are equal
        elif kind == "binary":
            value = F.hex(col)
        elif kind.startswith(("array", "struct", "map")):
            value = F.to_json(F.struct(col), {"ignoreNullFields": "false"})
        else:
            value = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("null")))
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Surplus duplicate rows (every occurrence after the first).

    Rows are counted by :func:`row_digest`, so 32 bytes a row are shuffled, however long its texts are; rows are
    equal if their SHA-256 is.
    """
    g = df.select(row_digest(df).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def distinct_counts(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """P5: distinct non-null values per column (``approx`` uses HyperLogLog++ at scale)."""
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return _long(df.agg(*[f(F.col(c)).alias(c) for c in df.columns]), "n_distinct")


def corpus_stats(df: DataFrame, col: str = "corpus") -> DataFrame:
    """Rows, rounded mean length, non-null count of a text column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.length(col))).cast("long").alias("mean_length"),
        F.count(F.col(col)).alias("non_null"),
    )


def key_coverage(catalog: DataFrame, sides: dict[str, DataFrame], cat_col: str = "commodity_name",
                 side_col: str = "commodity_name") -> DataFrame:
    """Per side, distinct strip+lower names, how many exist in the catalog, match rate %.

    The rate divides by the distinct count unguarded like the reference; 0 distinct names gives null.
    """
    cat = catalog.select(join_key(cat_col).alias("k")).where(F.col("k").isNotNull()).distinct()
    parts = []
    for name, df in sides.items():
        keys = df.select(join_key(side_col).alias("k")).where(F.col("k").isNotNull()).distinct()
        matched = keys.join(cat, "k", "left_semi")
        parts.append(
            keys.agg(F.count(F.lit(1)).alias("distinct_names")).withColumn("_j", F.lit(1))
            .join(matched.agg(F.count(F.lit(1)).alias("matched")).withColumn("_j", F.lit(1)), "_j")
            .select(F.lit(name).alias("side"), "distinct_names", "matched")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rate = F.when(F.col("distinct_names") > 0, F.col("matched") / F.col("distinct_names") * 100.0)
    return out.withColumn("match_rate", rate).withColumn("missing", F.col("distinct_names") - F.col("matched"))


def missing_keys(catalog: DataFrame, side: DataFrame, cat_col: str = "commodity_name",
                 side_col: str = "commodity_name") -> DataFrame:
    """The side's strip+lower names absent from the catalog (anti join)."""
    cat = catalog.select(join_key(cat_col).alias("missing_name"))
    keys = side.select(join_key(side_col).alias("missing_name")).where(F.col("missing_name").isNotNull()).distinct()
    return keys.join(cat, "missing_name", "left_anti")


def compatibility_report(catalog: DataFrame, products: DataFrame, cat_col: str = "commodity_name",
                         side_col: str = "commodity_name") -> DataFrame:
    """One row with total_products, distinct_names, matched, missing and match_rate (%, null without names)."""
    cov = key_coverage(catalog, {"products": products}, cat_col, side_col)
    return products.agg(F.count(F.lit(1)).alias("total_products")).crossJoin(F.broadcast(cov)).select(
        "total_products", "distinct_names", "matched", "missing", "match_rate")


def preview(df: DataFrame, n: int = 5, order_by: str | list | None = None, cols: list | None = None) -> DataFrame:
    """First ``n`` rows under an explicit order (a preview is the limit's purpose)."""
    d = df.select(*cols) if cols else df
    if order_by:
        d = d.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return d.limit(n)


# ---------------------------------------------------------------- sketches that merge

def distinct_sketches(df: DataFrame, cols: list[str], part_cols: list[str], lg_k: int = 14) -> DataFrame:
    """(part_cols..., column_name, sketch): one Theta sketch per part and column, to be stored and merged later.

    A sketch keeps the smallest hashes of a column's distinct non-null values, 2^``lg_k`` at most, so it has a fixed
    size; the relative standard error of what it counts is about 1 / sqrt(2^lg_k), and it is exact below 2^lg_k.
    """
    aggs = [F.theta_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in cols]
    return df.groupBy(*part_cols).agg(*aggs).unpivot(part_cols, cols, "column_name", "sketch")


def sketched_distinct_counts(sketches: DataFrame, lg_k: int = 14) -> DataFrame:
    """P5 from stored sketches of any parts: (column_name, n_distinct)."""
    return sketches.groupBy("column_name").agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_k)).alias("n_distinct"))


def sketched_key_coverage(catalog: DataFrame, sides: dict[str, DataFrame], cat_col: str = "commodity_name", side_col: str = "commodity_name",
                          lg_k: int = 14) -> DataFrame:
    """P7 from one sketch per table: (side, distinct_names, matched, match_rate, missing), by set intersection of sketches."""
    key = lambda df, c: df.agg(F.theta_sketch_agg(join_key(c), lg_k).alias("s"))
    cat = key(catalog, cat_col).withColumnRenamed("s", "catalog")
    out = None
    for name, df in sides.items():
        one = key(df, side_col).crossJoin(F.broadcast(cat)).select(  # two one-row tables
            F.lit(name).alias("side"), F.theta_sketch_estimate("s").alias("distinct_names"), F.theta_sketch_estimate(F.theta_intersection("s", "catalog")).alias("matched"))
        out = one if out is None else out.unionByName(one)
    rate = F.when(F.col("distinct_names") > 0, F.col("matched") / F.col("distinct_names") * 100.0)
    return out.withColumn("match_rate", rate).withColumn("missing", F.col("distinct_names") - F.col("matched"))
