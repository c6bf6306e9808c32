"""Containment truth join: token-anchored form and chunked short-passage scans vs brute force."""

from hiermatch.operators import containment


def test_contains_join_matches_brute_force(spark):
    docs = [(1, "the red fox jumps over the lazy dog"), (2, "a lazy afternoon, red wine"), (3, "foxes and dogs")]
    passages = [(10, "red fox jumps"), (11, "lazy"), (12, "azy do"), (13, "fox"), (14, "red w"), (15, "cat")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    p = spark.createDataFrame(passages, "item_id long, text string")
    want = {(pi, di) for pi, pt in passages for di, dt in docs if pt in dt}
    for bound in (containment.MAX_SHORT_PASSAGE_BYTES, 20):  # 20 bytes forces several chunks
        got = {(r["item_id"], r["doc_id"]) for r in
               containment.contains_join(p, d, max_broadcast_bytes=bound).collect()}
        assert got == want


def test_passage_with_line_break_takes_the_token_join(spark):
    passages = spark.createDataFrame([(1, "one two\nthree four"), (2, "zz")], "item_id long, text string")
    docs = spark.createDataFrame([(5, "x one two\nthree four y"), (6, "azzb"), (7, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in containment.contains_join(passages, docs).collect()) == [(1, 5), (2, 6)]
