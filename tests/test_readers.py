"""Columns by header name, row positions, quoting."""

import pytest

from hiermatch.operators import evaluate, hierarchy, training
from hiermatch.sources import readers

CATALOG = ("Segment Code,Segment Name,Family Code,Family Name,Class Code,Class Name,Commodity Code,Commodity Name\n"
           "1,S1,1,F1,1,C1,30,Pen\n1,S2,1,F2,1,C2,10,Pen\n1,S3,1,F3,1,C3,20,Pen\n")


def test_columns_go_by_name(spark, tmp_path):
    (tmp_path / "q.csv").write_text('UNSPSC Commodity Name,Extra,Search Query\nPen,x,"blue ""pen"", long"\n')
    got = readers.read_queries(spark, f"{tmp_path}/q.csv").collect()
    assert [(r["search_query"], r["commodity_name"]) for r in got] == [('blue "pen", long', "Pen")]
    (tmp_path / "bad.csv").write_text("Search Query,Other\na,b\n")
    with pytest.raises(ValueError, match="UNSPSC Commodity Name"):
        readers.read_queries(spark, f"{tmp_path}/bad.csv")


def test_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Original Description,UNSPSC Commodity Name\n"two\nlines",Pen\n')
    got = readers.read_products(spark, f"{tmp_path}/p.csv", multi_line=True).collect()
    assert [r["description"] for r in got] == ["two\nlines"]


def test_first_and_last_row_win_by_position(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CATALOG)
    cat = readers.read_catalog(spark, f"{tmp_path}/c.csv")
    assert evaluate.name_to_code(cat).first()["true_code"] == 30
    assert hierarchy.reverse_lookup(cat).first()["segment_name"] == "S3"
    assert training.name_to_corpus(cat).first()["positive"] == "s3 f3 c3 pen"
    assert training.first_row_levels(cat).first()["true_segment"] == "S1"


def test_ids_are_stable_over_several_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"f{n}.csv").write_text("Search Query,UNSPSC Commodity Name\n" + "".join(f"q{n}{i},n\n" for i in range(5)))
    a, b = ({r["search_query"]: r["query_id"] for r in readers.read_queries(spark, str(tmp_path)).collect()} for _ in range(2))
    assert a == b and len(set(a.values())) == 15


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_quoted_line_breaks_over_many_blocks(spark, tmp_path, block):
    """Fields longer than a block, breaks and quotes at block borders, two files, blank lines: rows as Python's csv has them."""
    import csv
    import random

    from hiermatch.sources import csv_blocks

    rng = random.Random(block)
    bits = ["a", "\n", '"', ",", " ", "é", "word", "\n\n", '""', "x" * 40, "'"]
    want = {}
    for f in range(2):
        rows = [("".join(rng.choice(bits) for _ in range(rng.choice([1, 3, 9, 60]))) + "z", f"n{i}") for i in range(150)]
        with open(tmp_path / f"f{f}.csv", "w", newline="") as out:
            w = csv.writer(out, lineterminator="\n")
            w.writerows([("Original Description", "UNSPSC Commodity Name"), *rows[:70]])
            out.write("\n")
            w.writerows(rows[70:])
        want[f"f{f}.csv"] = rows
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        tasks = csv_blocks.records(spark, str(tmp_path)).rdd.getNumPartitions()
        got = readers.read_products(spark, str(tmp_path), multi_line=True).select("row_pos", "description", "commodity_name").orderBy("row_pos").collect()
        plain = spark.read.options(**readers.CSV_OPTIONS, multiLine="true").csv(str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {n: [(r.description, r.commodity_name) for r in got if r.row_pos.file.endswith(n)] for n in want}
    assert by_file == want and sorted(map(tuple, plain)) == sorted(x for rows in want.values() for x in rows)
    assert block == 1 << 20 or tasks > 20


def test_parallel_reader_checks_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Search Query,UNSPSC Commodity Name\nq,n\n")
    (tmp_path / "b.csv").write_text("UNSPSC Commodity Name,Search Query\nn,q\n")
    with pytest.raises(Exception, match="another header"):
        readers.read_queries(spark, str(tmp_path), multi_line=True).collect()
