"""Line deduplication: maximal repeated runs of lines by distributed prefix doubling."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: What counts as a word when a run is judged by its length in words.
WORD = re.compile(r"[^\x20\t-\r]+")


def _doc_key(id_col: str, text_col: str):
    """Texts repeated under one id are told apart by a hash; equal rows have one key."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("v"))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """(doc, pos, line): the SHA-256 of every line of every text that has an id."""
    base = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    base = base.select(_doc_key(id_col, text_col).alias("doc"), F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
    line = F.col("line") if normalise is None else F.coalesce(normalise(F.col("line")), F.lit(""))
    return base.select("doc", "pos", F.unhex(F.sha2(line, 256)).alias("line"))


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(doc, pos, f) of the ``rows`` whose ``keys`` recur; f is the first (doc, pos) of their class.

    Classes are counted with partial aggregation, so a class that holds a share of all rows is not
    gathered; the join back has one row per class on the other side.
    """
    place = F.struct("doc", "pos")
    first = rows.groupBy(*keys).agg(F.min(place).alias("f"), F.max(place).alias("l")).where("f != l").drop("l")
    # A table of its own, so that the join stands alone in its stage and a hot class can be split there.  It is
    # one plan at every size: a broadcast would depend on how well the classes compress.
    return rows.join(save(first, "line-classes").hint("merge"), keys).select("doc", "pos", "f")


def suffix_classes(lines: DataFrame, min_lines: int) -> list[tuple[int, DataFrame]]:
    """Prefix doubling over the line sequences: for h = 1, 2, 4, ... the suffixes whose first h lines recur.

    Each level is a table (doc, pos, f): the class of suffixes that share their first h lines (an interval
    of the suffix array whose longest common prefix is at least h) is named by its first member in (doc,
    pos) order.  The next level pairs the names of pos and pos + h.  A suffix alone in its class can share
    no longer prefix and is left out from then on, so the tables shrink; doubling ends when h exceeds
    ``min_lines``, the shortest run looked for.  Equal classes are all that is needed of the array: the
    order between different suffixes is never used.
    """
    level = save(_named(lines, ["line"]).distinct(), "lines-1")
    out, h = [(1, level)], 1
    while 2 * h <= min_lines:
        level = save(_named(_paired(level, h), ["name", "next"]), f"lines-{2 * h}")
        h *= 2
        out.append((h, level))
    return out


def _paired(level: DataFrame, by: int) -> DataFrame:
    """(doc, pos, name, next): the class of each suffix and that of the suffix ``by`` lines on."""
    ahead = level.select("doc", (F.col("pos") - by).alias("pos"), F.col("f").alias("next"))
    return level.withColumnRenamed("f", "name").join(ahead, ["doc", "pos"])


def _of_length(levels: list[tuple[int, DataFrame]], n: int) -> DataFrame:
    """(doc, pos, f): the classes of ``n`` lines, as two overlapping prefixes of the longest doubled length up to n."""
    h, level = [x for x in levels if x[0] <= n][-1]
    return level if h == n else _named(_paired(level, n - h), ["name", "next"])


_LATER = "doc != f.doc or pos != f.pos"


def repeated_starts(lines: DataFrame, min_lines: int) -> DataFrame:
    """(doc, pos, f): starts of ``min_lines`` consecutive lines that occur earlier, and the first place
    (smallest doc, then pos) where they do.

    The class of ``min_lines`` lines is that of two overlapping prefixes of the last doubled length.
    """
    return _of_length(suffix_classes(lines, min_lines), min_lines).where(_LATER)


def short_starts(levels: list[tuple[int, DataFrame]], min_lines: int, min_words: int | None, min_docs: int | None) -> DataFrame | None:
    """(doc, first_line, n_lines, need): starts of fewer than ``min_lines`` lines that occur earlier and go if they
    hold at least ``need`` words: ``min_words``, or one if ``min_docs`` different ids share the line.

    Lines of a shared run are each shared as widely, so classes of single lines are enough for ``min_docs``.
    """
    out = None
    for n in range(1, min_lines) if min_words is not None else ():
        later = _of_length(levels, n).where(_LATER).select("doc", F.col("pos").alias("first_line"), F.lit(n).cast("long").alias("n_lines"),
                                                           F.lit(min_words).alias("need"))
        out = later if out is None else out.unionByName(later)
    if min_docs is not None and min_lines > 1:
        line = levels[0][1]
        wide = line.select("f", F.col("doc.id").alias("id")).distinct().groupBy("f").count().where(F.col("count") >= min_docs).select("f")
        wide = line.where(_LATER).join(save(wide, "line-wide").hint("merge"), "f").select(
            "doc", F.col("pos").alias("first_line"), F.lit(1).cast("long").alias("n_lines"), F.lit(1).alias("need"))
        out = wide if out is None else out.unionByName(wide)
    return out


def maximal_runs(starts: DataFrame, min_lines: int) -> DataFrame:
    """(doc, first_line, n_lines, f_doc, f_line): neighbouring starts that continue one earlier copy, merged.

    A run ends where the next line is no longer the next line of the copy it follows, so its longest
    common prefix with that copy is n_lines.  Windows are within one text.
    """
    rows = starts.select("doc", "pos", F.col("f.doc").alias("f_doc"), (F.col("pos") - F.col("f.pos")).alias("shift"))
    nth = F.row_number().over(Window.partitionBy("doc", "f_doc", "shift").orderBy("pos"))
    runs = rows.withColumn("island", F.col("pos") - nth).groupBy("doc", "f_doc", "shift", "island").agg(
        F.min("pos").alias("first_line"), F.count(F.lit(1)).alias("n"))
    return runs.select("doc", "first_line", (F.col("n") + (min_lines - 1)).alias("n_lines"), "f_doc",
                       (F.col("first_line") - F.col("shift")).alias("f_line"))


def line_dedup(docs: DataFrame, min_lines: int = 3, id_col: str = "doc_id", text_col: str = "text",
               normalise=None, with_text: bool = False, min_words: int | None = None, min_docs: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, kept_sha256 (and ``text``, the lines that stay).

    Lines are what stands between newlines, compared whole (by SHA-256) after ``normalise`` (Column ->
    Column, default none).  A run of at least ``min_lines`` consecutive lines of one text that also occurs
    at an earlier place (smaller id, or the same id and an earlier line) is a later copy, and its lines go;
    runs are judged on the input, not on what is left.  Copies inside one text, overlapping ones too, count.
    With ``min_words`` a shorter run that occurs earlier goes too if it has that many words (what stands between
    ASCII white space), and with ``min_docs`` a line with a word in it that stands under that many different ids.

    A null text has no line, n_removed 0 and the hash of the empty text; an empty text has one empty line.
    Rows with a null id are returned unchanged and are nobody's earlier copy.  Equal rows repeated with one
    id are one text and have equal results; different texts under one id are ordered by a hash.  An empty
    table gives an empty result; other columns are ignored.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    if min(x for x in (min_words, min_docs, 1) if x is not None) < 1:
        raise ValueError("min_words and min_docs must be at least 1")
    base = docs.select(_doc_key(id_col, text_col).alias("doc"), F.col(text_col).alias("text"))
    levels = suffix_classes(line_rows(docs, id_col, text_col, normalise), min_lines)
    starts = save(_of_length(levels, min_lines).where(_LATER), "line-starts")
    runs = maximal_runs(starts, min_lines).select("doc", "first_line", "n_lines", F.lit(0).alias("need"))
    short = short_starts(levels, min_lines, min_words, min_docs)
    runs = runs if short is None else runs.unionByName(short)
    runs = runs.groupBy("doc").agg(  # at most the lines of one text, for each length
        F.collect_list(F.struct("first_line", "n_lines", "need")).alias("runs"))
    runs = save(runs, "line-runs")
    rows = base.join(runs.hint("merge"), "doc", "left").select(F.col("doc.id").alias("doc_id"), "text", "runs")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_lines long, n_removed long, kept_sha256 string, text string"

    judged = short is not None

    def cut(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                parts = [] if text is None else text.split("\n")
                words = [len(WORD.findall(x)) for x in parts] if found and judged else None
                gone = {i for r in found or () for i in range(r["first_line"], r["first_line"] + r["n_lines"])
                        if not r["need"] or sum(words[r["first_line"]:r["first_line"] + r["n_lines"]]) >= r["need"]}
                kept = "\n".join(x for i, x in enumerate(parts) if i not in gone)
                out.append((len(parts), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if with_text else None))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                                             names=["doc_id", "n_lines", "n_removed", "kept_sha256", "text"])

    out = rows.mapInArrow(cut, schema)
    return out if with_text else out.drop("text")
