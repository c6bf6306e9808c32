"""G1-G6 sampler: exact cyclic picks, including queries whose first window is mostly truth rows."""

import hashlib
import random

from pyspark.sql import functions as F

from hiermatch.operators import training as G


def test_cyclic_sample_doubling_is_exact(spark):
    size = 40
    names = ["t" if i % 8 else f"x{i}" for i in range(size)]  # 35 truth-named rows, 5 others
    pool = spark.createDataFrame([("g", i, size, names[i], f"row{i}") for i in range(size)],
                                 "grp string, pos long, group_size long, name_key string, payload string")
    queries = spark.createDataFrame([(q, "g", "t") for q in range(1, 30)] + [(99, "g", "x0")],
                                    "query_id long, grp string, truth_key string")
    got = G.cyclic_sample(queries, pool, "grp", n=4).select("query_id", "pick", "payload").collect()
    offsets = {r["query_id"]: r["o"] for r in queries.select(
        "query_id", G.md5_offset(G.SEED, "query_id", F.lit(size)).alias("o")).collect()}
    want = set()
    for q, o in offsets.items():
        truth = "x0" if q == 99 else "t"
        picks = [p for p in ((o + j) % size for j in range(size)) if names[p] != truth][:4]
        want |= {(q, k + 1, f"row{p}") for k, p in enumerate(picks)}
    assert {(r["query_id"], r["pick"], r["payload"]) for r in got} == want


def test_cyclic_sample_equals_brute_force_at_every_size(spark):
    """Runs of names that wrap, groups of one name, groups smaller than n, null names, unknown and null groups."""
    rng = random.Random(3)
    rows, queries = [], []
    for g in range(25):
        size = rng.choice([1, 2, 3, 5, 9, 30, 90])
        names = [rng.choice(["t", "t", "t", "x", None, "y"]) if g % 3 else rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(size)]
        if g == 4:
            names = ["t"] * size
        rows += [(f"g{g}", p, size, names[p], f"{g}/{p}") for p in range(size)]
        queries += [(100 * g + i, f"g{g}", t) for i, t in enumerate(["t", "x", "zz", None, *names[:5]])]
    queries += [(9001, "none", "t"), (9002, None, "t")]
    pool = spark.createDataFrame(rows, "grp string, pos long, group_size long, name_key string, payload string").repartition(5)
    asked = spark.createDataFrame(queries, "query_id long, grp string, truth_key string")
    sizes = {r[0]: r[2] for r in rows}
    at = {(r[0], r[1]): r for r in rows}
    for n in (1, 2, 4):
        got = {(r.query_id, r.pick, r.payload) for r in G.cyclic_sample(asked, pool, "grp", n).collect()}
        want = set()
        for q, g, t in queries:
            if g in sizes:
                offset = int(hashlib.md5(f"{G.SEED}|{q}".encode()).hexdigest()[:8], 16) % sizes[g]
                ring = [at[g, (offset + j) % sizes[g]] for j in range(sizes[g])]
                want |= {(q, k + 1, r[4]) for k, r in enumerate([r for r in ring if r[3] != t][:n])}
        assert got == want


def test_name_runs_across_blocks(spark):
    names = [c for c in "aaaabbbacccccccdaab" for _ in range(3)]
    pool = spark.createDataFrame([("g", p, x) for p, x in enumerate(names)], "grp string, pos long, name_key string")
    got = [(r.run, r.n_runs) for r in G.name_runs(pool, "grp", block=4).orderBy("pos").collect()]
    want = [0]
    for a, b in zip(names, names[1:]):
        want.append(want[-1] + (a != b))
    assert got == [(x, want[-1] + 1) for x in want]


def test_sampling_plans_run_no_job(spark):
    """Building the triples and pairs starts no job: the plans are lazy."""
    cat = spark.createDataFrame([(i, f"s{i % 2}", f"f{i % 4}", f"name {i % 9}", f"text {i}") for i in range(40)],
                                "commodity_code long, segment_name string, family_name string, commodity_name string, corpus string")
    q = spark.createDataFrame([(i, f"query {i}", f"name {i % 9}") for i in range(20)], "query_id long, search_query string, commodity_name string")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("sampling-plans", "plans only")
    triples, pairs = G.hard_triples(q, cat), G.labelled_pairs(q, cat)
    jobs = tracker.getJobIdsForGroup("sampling-plans")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs and triples.count() == 100 and pairs.count() == 120


def test_hard_triples_broadcast_no_table(spark, sf):
    """A table that is small on disk only because it compresses must not pass through the driver."""
    from hiermatch.plans import QUERIES

    for name in ("g_hard_triples", "g_pairs"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
