"""CSV files with quoted line breaks, read by many tasks per file.

A line break belongs to a field if the quotes before it in the file are odd in number.  Pass 1 counts the quotes of each
file block and sums them over the blocks before, which tells whether a block begins inside a field.  Pass 2 cuts
each block into records at the breaks outside fields; what a block leaves open is joined with the beginnings of the
blocks after it.  Blocks are Spark's own splits of the text source, so a file takes as many tasks as it has blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PIECES = "file string, start long, nth long, kind string, text string"


def _cut(batches):
    """Pieces of blocks: whole records, and lines that close, continue or open a record of several blocks.

    Rows come in file order: value, file, start, odd (whether the block begins inside a field).
    """
    block, inside, begun, held, nth = None, False, False, [], 0

    def ended():
        # what is left when a block ends: an open record, or a block that lies inside one field
        if block is not None and held:
            yield (*block, nth, "open" if begun else "through", "\n".join(held))

    for batch in batches:
        rows = []
        values = batch.column(0).to_pylist()
        quotes = pc.count_substring(batch.column(0), '"').to_numpy(zero_copy_only=False).astype(np.int64) % 2 == 1
        for value, file, start, odd, flips in zip(values, *(batch.column(i).to_pylist() for i in (1, 2, 3)), quotes.tolist()):
            if (file, start) != block:
                rows += ended()
                block, inside, begun, held, nth = (file, start), odd, not odd, [], 0
            held.append(value)
            inside ^= flips
            if not inside:
                rows.append((*block, nth, "whole" if begun else "close", "\n".join(held)))
                begun, held, nth = True, [], nth + 1
        yield _batch(rows)
    yield _batch(list(ended()))


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                      ["file", "start", "nth", "kind", "text"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, nth, text): the records of all files below ``path`` in file order, the header records included.

    Blank records are left out.  A file that ends inside a field keeps what it has as its last record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))  # one row per block
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    pieces = lines.join(F.broadcast(blocks), ["file", "start"]).select("value", "file", "start", "odd").mapInArrow(_cut, _PIECES)
    whole = pieces.where("kind = 'whole'").select("file", "start", "nth", "text")
    # At most two pieces of a block belong to records of several blocks.
    parts = pieces.where("kind != 'whole'")
    along = Window.partitionBy("file").orderBy("start", "nth")
    parts = parts.withColumn("chain", F.sum((F.col("kind") == "open").cast("int")).over(along))
    joined = parts.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("start", "nth", "text"))).alias("p"))
    joined = joined.select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["nth"].alias("nth"), F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(joined).where(F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) > 0).withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def read_csv(spark: SparkSession, path: str, columns: list[str], options: dict) -> DataFrame:
    """The columns of the files as strings, plus file, start and nth; ``columns`` is the header of every file.

    A file whose first record is another header fails the read.
    """
    found = records(spark, path)
    parsed = F.from_csv("text", ", ".join(f"`{c}` STRING" for c in columns), {k: v for k, v in options.items() if k not in ("header", "enforceSchema")})
    first = (F.col("start") == 0) & (F.col("nth") == 0)
    rows = found.select("file", "start", "nth", first.alias("first"), parsed.alias("row"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col("row")[c].eqNullSafe(F.lit(c))
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    kept = F.when(~F.col("first"), True).when(same, False).otherwise(wrong)
    return rows.where(kept).select("file", "start", "nth", *[F.col("row")[c].alias(c) for c in columns])
