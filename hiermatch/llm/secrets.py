"""Secret scan, DataFrame functions only: pattern rules, and a randomness test battery on encoded tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

# The patterns of the three rules, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of 20 characters or more; shorter runs are no match at all
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Candidates of the battery.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"

#: Inferred encodings: name, pattern, alphabet, and the share of equal pairs of characters expected of ordinary
#: (not random) strings in it.
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.12),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.066),
    ("lower", "^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.066),
    ("alnum", "^[A-Za-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.066),
    ("base64", "", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_", 0.066),
)
#: Steps of the p-value grid on which the false-discovery rate is controlled.
GRID = 40


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def running_sums(steps: Column, block: int = 32) -> Column:
    """The running sums of an array of ints that is not empty; sums inside blocks and over blocks, so that no array grows by one
    element at a time over the whole length."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    none = F.array().cast("array<int>")

    def within(blk, before):
        return F.transform(blk, lambda _, i: before + total(F.slice(blk, F.lit(1), i + 1)))

    def over(blocks):
        firsts = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, blk: F.struct(
            (acc["at"] + total(blk)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, firsts, within))

    cut = _bind(steps, lambda a: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")), lambda j: F.slice(a, j * block + 1, F.lit(block))))
    return _bind(cut, over)


def spans(text: Column, pattern: str, good=None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as (start, end, matched text), in code points, that
    satisfy ``good`` (Column -> Column).

    The pieces between matches and the matches themselves alternate, so their lengths add up to positions.
    """
    def placed(found):
        steps = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, hit: F.length(gap) + F.length(hit))
        spots = F.zip_with(found, running_sums(steps), lambda hit, end: F.struct(
            (end - F.length(hit)).alias("s"), end.alias("e"), hit.alias("x")))
        return F.when(F.size(found) > 0, spots).otherwise(F.array().cast("array<struct<s:int,e:int,x:string>>"))  # most texts have none

    out = _bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return out if good is None else F.filter(out, lambda m: good(m["x"]))


def normal_below(z: Column) -> Column:
    """P(Z <= z) of the standard normal distribution, by the rational approximation of Abramowitz and Stegun 26.2.17."""
    t = F.lit(1.0) / (F.lit(1.0) + 0.2316419 * F.abs(z))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z > 0, F.lit(1.0) - tail).otherwise(tail)


def battery(token: Column) -> Column:
    """(enc, n, p_random, p_plain) of a token; padding '=' at its end is not counted.

    p_random: three times the smallest p-value of three tests that the characters are uniform and
    independent in the inferred alphabet: chi-squared for uniformity, a runs test around the middle of the
    alphabet, and the lag-one serial correlation.  p_plain: the p-value of the share of equal pairs of
    characters, if they were as uneven as in ordinary strings of the encoding; its spread shrinks with length.
    """
    body = F.regexp_replace(token, "=+$", "")
    enc = F.lit(len(ENCODINGS) - 1)
    for i in reversed(range(len(ENCODINGS) - 1)):
        enc = F.when(body.rlike(ENCODINGS[i][1]), i).otherwise(enc)

    def measured(body, enc):
        pick = lambda values: F.array(*map(F.lit, values))[enc]
        alphabet, k, plain = pick([e[2] for e in ENCODINGS]), pick([float(len(e[2])) for e in ENCODINGS]), pick([e[3] for e in ENCODINGS])
        chars = F.when(enc == 0, F.lower(body)).otherwise(body)
        values = _bind(alphabet, lambda a: F.transform(F.split(chars, ""), lambda c: F.instr(a, c) - 1))
        return _bind(F.struct(values.alias("v"), k.alias("k"), plain.alias("plain"), enc.alias("enc")), tests)

    def tests(x):
        v, k, plain = x["v"], x["k"], x["plain"]
        n = F.size(v).cast("double")
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        squares = total(F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda c: F.pow(F.size(F.filter(v, lambda y: y == c)).cast("double"), 2.0)))
        df = k - 1
        chi = F.greatest(squares * k / n - n, F.lit(0.0))
        z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        first, later = F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1)
        high = F.size(F.filter(v, lambda y: y >= k / 2)).cast("double")
        low = n - high
        runs = 1 + F.size(F.filter(F.zip_with(first, later, lambda a, b: (a >= k / 2) != (b >= k / 2)), lambda y: y)).cast("double")
        mean = 1 + 2 * high * low / n
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        z_runs = (runs - mean) / spread
        sum1, sum2 = total(F.transform(v, lambda y: y.cast("double"))), total(F.transform(v, lambda y: (y * y).cast("double")))
        cross = total(F.zip_with(first, later, lambda a, b: (a * b).cast("double")))
        var = F.greatest(sum2 / n - F.pow(sum1 / n, 2.0), F.lit(1e-9))
        corr = (cross / (n - 1) - F.pow(sum1 / n, 2.0)) / var
        z_corr = (corr + 1 / n) * F.sqrt(n)
        two = lambda z: 2 * normal_below(-F.abs(z))
        pairs = (squares - n) / (n * (n - 1))
        z_plain = (pairs - plain) / F.sqrt(2 * plain * (1 - plain) / (n * (n - 1)) + plain * plain / n)
        # The scores are computed once; the approximation of the normal distribution names its argument often.
        return _bind(F.struct(z_chi.alias("chi"), z_runs.alias("runs"), z_corr.alias("corr"), z_plain.alias("plain")), lambda z: F.struct(
            x["enc"].alias("enc"), F.size(v).alias("n"),
            F.least(F.lit(1.0), 3 * F.least(normal_below(-z["chi"]), two(z["runs"]), two(z["corr"]))).alias("p_random"),
            normal_below(z["plain"]).alias("p_plain")))

    return F.when(F.length(body) >= 16, _bind(F.struct(body.alias("body"), enc.alias("enc")), lambda b: measured(b["body"], b["enc"])))


def length_class(n: Column) -> Column:
    """20-23, 24-31, 32-47, 48-95, 96 and more: tests are weaker on short tokens, so each class has its own control."""
    return F.when(n < 24, 0).when(n < 32, 1).when(n < 48, 2).when(n < 96, 3).otherwise(4)


def step(p: Column) -> Column:
    """The step of the grid 2^0, 2^-1, ..., 2^-GRID that p is at or below."""
    return F.least(F.lit(GRID), F.floor(-F.log2(F.greatest(p, F.lit(1e-300))))).cast("int")


def thresholds(candidates: DataFrame, rate: float) -> dict[int, int]:
    """Per length class the least strict step at which at most ``rate`` of the discoveries are expected to be
    false (Benjamini-Hochberg on the grid; the whole table is collected: 5 classes x (GRID + 1) rows)."""
    counts: dict[int, dict[int, int]] = {}
    for r in candidates.groupBy("cls", "step").count().collect():
        counts.setdefault(r.cls, {})[r.step] = r["count"]
    out = {}
    for cls, at in counts.items():
        total, found = sum(at.values()), 0
        for s in range(GRID, 0, -1):
            found += at.get(s, 0)
            if found and 2.0 ** -s * total <= rate * found:
                out[cls] = s
    return out


def secrets(docs: DataFrame, rate: float = 0.01, reject: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_random, base (array of kind, start, end),
    found (array of kind, start, end: the base spans and those of the battery).

    Positions count code points; ends are exclusive.  A token of 20 or more characters that no base span
    overlaps is added as 'random' if the battery does not reject that it is random (p_random >= ``reject``)
    and it is a discovery against ordinary strings at a false-discovery rate of ``rate`` among the tokens of
    its length class, over all rows.

    Null and empty texts have no spans.  Null ids are carried along and repeated rows repeat their result.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select(
        "doc_id",
        spans(text, ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6).alias("assign"),
        spans(text, ACCESS).alias("access"), spans(text, HEX).alias("hex"), spans(text, TOKEN).alias("tokens"))

    def kind(name):
        i = KINDS.index(name)
        return F.transform(name, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    rows = rows.withColumn("base", F.array_sort(F.concat(kind("assign"), kind("access"), kind("hex"))))
    free = F.filter("tokens", lambda t: ~F.exists(F.col("base"), lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    rows = rows.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]), "base",
                       F.transform(free, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), battery(t["x"]).alias("test"))).alias("tokens"))
    rows = save(rows, "secrets")

    tested = rows.select(F.explode("tokens").alias("t")).where("t.test is not null")
    strict = thresholds(tested.select(length_class(F.col("t.test.n")).alias("cls"), step(F.col("t.test.p_plain")).alias("step")), rate)

    def secret(t):
        enough = F.lit(False)
        for cls, s in strict.items():
            enough = enough | ((length_class(t["test"]["n"]) == cls) & (step(t["test"]["p_plain"]) >= s))
        return F.coalesce((t["test"]["p_random"] >= reject) & enough, F.lit(False))

    added = F.transform(F.filter("tokens", secret), lambda t: F.struct(t["s"].alias("s"), F.lit(3).alias("k"), t["e"].alias("e")))
    name = F.array(*map(F.lit, KINDS))
    show = lambda a: F.transform(a, lambda x: F.struct(name[x["k"]].alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.size(added).cast("long").alias("n_random"),
                       show("base").alias("base"), show(F.array_sort(F.concat("base", added))).alias("found"))


def joined(found: Column) -> Column:
    """'kind:start:end' of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
