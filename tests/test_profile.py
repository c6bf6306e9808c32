"""Profiles: duplicate rows by digest, sketches that merge."""

import pytest
from pyspark.sql import functions as F

from hiermatch.operators import profile as P


def test_duplicate_rows_of_odd_values(spark):
    rows = [(1, None, 0.0, ["a"]), (1, None, -0.0, ["a"]), (1, "null", 0.0, ["a"]), (11, "", 0.0, None), (1, "1|", 0.0, None), (None, "", None, []),
            (None, "", None, []), (None, "", None, None), (1, None, float("nan"), ["a"]), (1, None, float("nan"), ["a"])]
    df = spark.createDataFrame(rows, "a long, b string, c double, d array<string>")
    exact = df.groupBy(*df.columns).count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert P.duplicate_rows(df).first()[0] == exact == 3
    assert P.duplicate_rows(df.where("false")).first()[0] == 0
    assert P.duplicate_rows(df.withColumnRenamed("a", "x.y").unionByName(df.withColumnRenamed("a", "x.y"))).first()[0] == 13


def test_duplicate_rows_shuffle_digests_only(spark):
    plan = P.duplicate_rows(spark.createDataFrame([("x" * 100,)], "t string"))._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and all("hashpartitioning(digest" in line for line in keys)


@pytest.mark.parametrize("n", [50, 200_000])
def test_sketches_merge_within_their_error(spark, n):
    """Eight stored parts that overlap, counted and intersected: exact while few, within four standard errors beyond."""
    df = spark.range(2 * n).select((F.col("id") % 8).alias("part"), (F.col("id") % n).alias("v"), F.lit(None).cast("long").alias("none"))
    got = {r.column_name: r.n_distinct for r in P.sketched_distinct_counts(P.distinct_sketches(df, ["v", "none"], ["part"])).collect()}
    assert got["none"] == 0 and abs(got["v"] - n) <= (0 if n < 1 << 14 else 4 * n / 128)
    name = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit(" N"), "id").alias("commodity_name"))
    r = P.sketched_key_coverage(name(0, n), {"s": name(n // 2, n + n // 2), "empty": name(0, 0)}).collect()
    by = {x.side: x for x in r}
    assert abs(by["s"].matched - n // 2) <= (0 if n < 1 << 14 else 6 * n / 128) and by["empty"].match_rate is None
