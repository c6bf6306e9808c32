"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees are grown on a bounded labelled sample, every path from a root becomes a conjunctive rule,
a lasso logistic fit picks and weighs the rules, and the result is compiled into one Spark column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save
from .wordhash import LOWER, chunks, hashes, mix, words

STATISTICS = ("log_words", "log_lines", "mean_word", "upper", "digits", "pipes", "bangs", "symbols", "stops",
              "commas", "other_punct", "non_ascii", "short_words", "long_words", "new_words", "top_repeat",
              "same_as_before", "new_lines", "words_per_line", "caps_words")


def _share(mask: np.ndarray, off: np.ndarray, by: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mask, dtype=np.int64)]
    return (total[off[1:]] - total[off[:-1]]) / np.maximum(by, 1)


def _distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct hashes, and the count of the most frequent one."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    keyed = mix(h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at, count = np.unique(keyed, return_index=True, return_counts=True)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[at], count)
    return np.bincount(owner[at], minlength=n), top


#: Disjoint classes of bytes, numbered from 1; class 0 is all others.
_CLASSES = {"upper": range(0x41, 0x5B), "digits": range(0x30, 0x3A), "pipes": b"|", "bangs": b"!", "symbols": b"#$%&*@^~<>=+_\\/{}[]",
            "stops": b".?", "commas": b",;:", "other_punct": b"'\"()-`", "non_ascii": range(0x80, 0x100)}
_CLASS = np.zeros(256, np.uint8)
for _i, _chars in enumerate(_CLASSES.values(), 1):
    _CLASS[list(_chars)] = _i


def statistics_of(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; zeros for an empty text."""
    size = np.diff(off)
    starts, ends, first = words(buf, off)
    n_words = np.diff(first)
    h = hashes(LOWER[buf], starts, ends)
    width = ends - starts
    same = np.r_[False, h[1:] == h[:-1]] if len(h) else np.zeros(0, bool)
    same[first[:-1][first[:-1] < len(same)]] = False
    kinds = _CLASS[buf]
    of_kind = np.bincount(np.repeat(np.arange(len(size)) * 16, size) + kinds, minlength=16 * len(size)).reshape(-1, 16)
    caps = np.r_[0, np.cumsum(kinds == 1, dtype=np.int64)]
    shout = (caps[ends] - caps[starts] >= 2)
    new_words, top = _distinct(h, first)
    newline = np.arange(256) == 10
    ls, le, lfirst = words(buf, off, newline)
    n_lines = np.diff(lfirst)
    new_lines, _ = _distinct(hashes(buf, ls, le), lfirst)
    cols = [np.log1p(n_words), np.log1p(n_lines), np.bincount(np.repeat(np.arange(len(size)), n_words), width, len(size)) / np.maximum(n_words, 1)]
    cols += [of_kind[:, i] / np.maximum(size, 1) for i in range(1, len(_CLASSES) + 1)]
    cols += [_share(width <= 3, first, n_words), _share(width >= 15, first, n_words), new_words / np.maximum(n_words, 1),
             top / np.maximum(n_words, 1), _share(same, first, n_words), new_lines / np.maximum(n_lines, 1),
             n_words / np.maximum(n_lines, 1), _share(shout, first, n_words)]
    return np.stack(cols, axis=1)


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with an array column of STATISTICS (null text: as empty)."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part, buf, off in chunks(batch, at):
                x = statistics_of(buf, off)
                flat = pa.array(x.reshape(-1))
                col = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*part.columns, col], names=[f"c{i}" for i in range(len(part.columns) + 1)])

    schema = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(docs.dtypes)) + f", c{len(docs.columns)} array<double>"
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, name)


@dataclass
class RuleModel:
    """bias + sum of weights of the rules that hold; a rule is a list of (statistic, below?, threshold)."""

    bias: float
    rules: list[tuple[float, tuple[tuple[int, bool, float], ...]]] = field(default_factory=list)

    def column(self, stats: Column) -> Column:
        """The score in 0 to 1 as a Spark column over an array of STATISTICS."""
        total = F.lit(float(self.bias))
        for weight, rule in self.rules:
            total = total + F.when(_holds(rule, stats), F.lit(float(weight))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[i]} {'<=' if below else '>'} {t:.6g}" for i, below, t in r)
                for w, r in sorted(self.rules, key=lambda x: -abs(x[0]))]


def _holds(rule, stats: Column) -> Column:
    cond = F.lit(True)
    for i, below, t in rule:
        cond = cond & ((stats[i] <= F.lit(t)) if below else (stats[i] > F.lit(t)))
    return cond


def _paths(node, prefix=()):
    """Conjunctions on the way to every node below the root, from the JVM tree."""
    if node.getClass().getSimpleName() == "LeafNode":
        return
    split = node.split()
    for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
        path = (*prefix, (int(split.featureIndex()), below, float(split.threshold())))
        yield path
        yield from _paths(child, path)


def _tidy(path):
    """The tightest bound for each statistic and side, in a fixed order."""
    best: dict[tuple[int, bool], float] = {}
    for i, below, t in path:
        old = best.get((i, below))
        best[i, below] = t if old is None else (min if below else max)(old, t)
    return tuple((i, below, t) for (i, below), t in sorted(best.items()))


def fit_rules(sample: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 5e-4, seed: int = 7) -> RuleModel:
    """Fit on ``sample`` (stats array<double>, label int).  The caller bounds its size.

    Without rows or with one class only, the model is the constant (positives + 1) / (rows + 2).
    """
    sample = sample.select(array_to_vector("stats").alias("x"), F.col("stats"), F.col("label").cast("double").alias("y"))
    n, ones = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if ones in (0, n):
        return RuleModel(float(np.log((ones + 1) / (n - ones + 1))))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, maxBins=64, seed=seed,
                                    featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(sample)
    rules = sorted({_tidy(p) for t in forest.trees for p in _paths(t._java_obj.rootNode())})
    if not rules:
        return RuleModel(float(np.log((ones + 1) / (n - ones + 1))))
    held = F.array(*[_holds(r, F.col("stats")).cast("double") for r in rules])
    flat = LogisticRegression(featuresCol="r", labelCol="y", elasticNetParam=1.0, regParam=penalty, standardization=False,
                              maxIter=60).fit(sample.select(array_to_vector(held).alias("r"), "y"))
    return RuleModel(float(flat.intercept), [(float(w), r) for w, r in zip(flat.coefficients.toArray(), rules) if w])


def held_out(id_col) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 modulo 4 (null id: empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(stats: DataFrame, labels: DataFrame, max_labelled: int = 20_000, label_col: str = "quality", **fit) -> RuleModel:
    """Fit on at most ``max_labelled`` labelled rows that are not held out, taken in the order of a hash of the id.

    ``stats`` has doc_id and stats.  Null ids and labels are ignored; an id with several labels has the smallest.
    """
    truth = labels.where(F.col(label_col).isNotNull()).groupBy("doc_id").agg(F.min(label_col).alias("label"))
    truth = truth.where(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    n, spread = truth.count(), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    if n > 2 * max_labelled:  # so that the ordering below meets a bounded number of rows
        truth = truth.where(spread <= (1 << 20) * 1.5 * max_labelled / n)
    sample = stats.join(truth, "doc_id").orderBy(spread, "doc_id", F.xxhash64("stats")).limit(max_labelled)
    return fit_rules(save(sample.select("stats", "label").coalesce(1), "quality-sample"), **fit)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labelled: int = 20_000,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts have all statistics zero and are scored like any other.  Repeated rows are scored
    alike; a null id is not held out and never learnt from.  Empty documents give an empty result; without
    labels every score is the constant 0.5.  Other columns are ignored.
    """
    stats = save(with_statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text"), "quality-stats")
    model = train(stats, labels, max_labelled)
    scored = stats.select("doc_id", held_out("doc_id").alias("held_out"), model.column(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labelled: int = 20_000,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`quality` does not reject, with all their columns."""
    stats = save(with_statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text"), "quality-stats")
    model = train(stats, labels, max_labelled)
    name = "stats_of_" + "_".join(docs.columns)  # clashes with no column
    return with_statistics(docs, text_col, name).where(model.column(F.col(name)) >= threshold).drop(name)
