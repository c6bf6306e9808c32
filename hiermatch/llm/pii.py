"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Generators of candidates: wider than the base patterns on purpose, and free to overlap.
SOFT = ("soft_email", "soft_ip", "soft_number")
_AT, _DOT = r"(?:\s?@\s?|\s?[(\[]at[)\]]\s?|\sat\s)", r"(?:\s?\.\s?|\s?[(\[]dot[)\]]\s?|\sdot\s)"
#: The kinds of base span that a generator's candidates are examples of.
OF = (("email",), ("ip",), ("card", "phone"))
GENERATORS = (
    re.compile(rf"[A-Za-z0-9][A-Za-z0-9._%+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I),
    re.compile(r"(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|[0-9]{1,4}(?:[.][0-9]{1,4}){3}"),
    re.compile(r"[+(]?[0-9](?:[\x20(). /-]{0,2}[0-9]){6,18}"),
)
_PARTS = re.compile(rf"{_DOT}([A-Za-z0-9-]+)", re.I)
# The same spans in time linear in the text: addresses outwards from what stands for "@", digits taken whole.
_AT_HIT, _AT_SIGN = re.compile(rf"(?=({_AT}))", re.I), re.compile("(@)")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_SOFT_HOST = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", re.I)
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NAME_START = _NAME - frozenset("._%+-")


def _addresses(text: str, hits: re.Pattern, host: re.Pattern, start: frozenset):
    """(start, end) of the leftmost non-overlapping name + hit + host, the name's first character from ``start``."""
    last = 0
    for hit in hits.finditer(text):
        a, s = hit.start(1), hit.start(1)
        while s > last and text[s - 1] in _NAME:
            s -= 1
        while s < a and text[s] not in start:
            s += 1
        if s < a and (m := host.match(text, hit.end(1))):
            last = m.end()
            yield s, last


#: Last parts of a mail-like domain.
TLDS = frozenset("""com org net edu gov mil int info biz name pro io ai app dev eu de fr es it uk us ca at ch nl be lu dk se no
    fi pl cz sk hu ro bg gr pt ie is li ru ua tr il in cn jp kr tw hk sg my th id ph vn au nz za eg ng ke ma br mx ar cl co pe ve""".split())
#: Writings of "at" and "." that base addresses are taught in, and those of prose that is no address.
_ATS, _DOTTED = (" at ", " (at) ", "(at)", " [at] ", "[at]", " @ ", "\tat\t", " at\n", "@"), (".", " . ", " (dot) ", "[dot]", " dot ", "(dot)", " dot\n")
_PROSE_ATS, _PROSE_DOTS = (" at ", " at ", " at ", " @ "), (". ", ". ", ".", " . ")
_YEAR, _MONTH, _DAY = r"(?:1[89]|20)[0-9]{2}", r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12][0-9]|3[01])"
#: Numbers that claim to be a date (with or without a time) or a span of years.
DATE = re.compile(rf"{_YEAR}([-/.\x20]){_MONTH}\1{_DAY}(?:[^0-9].*)?|{_DAY}([-/.\x20]){_MONTH}\2{_YEAR}(?:[^0-9].*)?"
                  rf"|{_MONTH}([-/.\x20]){_DAY}\3{_YEAR}(?:[^0-9].*)?|{_YEAR}\x20?[-/]\x20?{_YEAR}", re.S)
#: Words before a number that say it is a phone number.
PHONE_CUE = re.compile(r"\b(?:(?:tele)?phone|telefon|tel|call|fax|mobile?|handy|móvil|teléfono|téléphone|portable)\b", re.I)
_CUES = tuple(re.compile(x, re.I) for x in (
    r"e-?mail|mail|contact|write|correo|courriel", r"\bip\b|host|server|login|adresse|address",
    r"card|visa|credit|konto|iban|carte|tarjeta|account", r"phone|tel|call|fax|mobil|handy|móvil|numéro"))
FEATURES = ("generator", "length", "digits", "digit_share", "letters", "groups", "longest_group", "shortest_group",
            "first_group", "separators", "kinds_of_separator", "plus", "parens", "dots", "ats", "luhn", "octets",
            "left", "right", "cue_mail", "cue_ip", "cue_card", "cue_phone", "tld", "at_word", "loose_dot", "brackets",
            "date", "zero", "grouped")


def luhn(digits: str) -> bool:
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + twice) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(parts) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _good(kind: str, hit: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return _octets(hit.split("."))
    d = _digits(hit)
    return 13 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed and then start."""
    good = []
    digit = re.search("[0-9]", text) is not None
    good += [("email", s, e) for s, e in _addresses(text, _AT_SIGN, _HOST, _NAME)]
    for kind, pattern, there in zip(KINDS[1:], (_QUAD, CARD, PHONE), (digit, digit, "+" in text and digit)):
        for m in pattern.finditer(text) if there else ():
            if _good(kind, m[0]):
                good.append((kind, m.start(), m.end()))
    return good


def _overlaps(good):
    """A function (start, end) -> kinds of the spans of ``good`` that overlap it; spans of a kind do not overlap each other."""
    by_kind = {k: ([a for x, a, _ in good if x == k], [b for x, _, b in good if x == k]) for k in KINDS}

    def over(s: int, e: int) -> set[str]:
        return {k for k, (starts, ends) in by_kind.items() if (i := bisect_right(ends, s)) < len(ends) and starts[i] < e}
    return over


def _side(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0


def _tld(s: str) -> bool:
    """Whether the last part of a candidate's domain ends a mail-like domain; 'It' after a sentence does not."""
    last = re.split(r"[^A-Za-z0-9-]+", s)[-1]
    return last.lower() in TLDS and last in (last.lower(), last.upper())


def _mail_end(s: str) -> int:
    """Where an address candidate ends: after its last part that ends a mail-like domain, else at its end."""
    ends = [m.end() for m in _PARTS.finditer(s) if _tld(m[1])]
    return ends[-1] if ends else len(s)


def features(text: str, generator: int, start: int, end: int) -> list[float]:
    """FEATURES of a candidate: its format, the characters beside it, and cue words up to 40 characters before it."""
    s, before = text[start:end], text[max(0, start - 40):start]
    groups = [len(g) for g in re.findall("[0-9]+", s)] or [0]
    d, seps = _digits(s), [c for c in s if not c.isalnum()]
    letters = sum(c.isalpha() for c in s)
    parts = re.findall("[0-9]+", s)
    return [float(x) for x in (
        generator, len(s), len(d), len(d) / len(s), letters, len(groups), max(groups), min(groups), groups[0], len(seps),
        len(set(seps)), s[0] == "+", "(" in s, s.count("."), s.count("@"), len(d) >= 13 and luhn(d),
        len(parts) == 4 and _octets(parts), _side(text[start - 1:start] if start else ""), _side(text[end:end + 1]),
        *(c.search(before) is not None for c in _CUES),
        generator == 0 and _tld(s), re.search(r"\sat\s", s, re.I) is not None, re.search(r"[^\s]\.\s", s) is not None,
        re.search(r"[(\[](?:at|dot)[)\]]", s, re.I) is not None,
        generator == 2 and DATE.fullmatch(s) is not None, s.lstrip("(").startswith("0"), len(groups) > 1)]


def candidates(text: str, good) -> list[dict]:
    """Spans of all generators with their features; label 1 if a base span of its kind overlaps it, else _label.
    Spans that overlap only base spans of other kinds are left out; ``free`` are those that overlap no base span."""
    out = []
    digit = re.search("[0-9]", text) is not None
    there = ("@" in text or re.search(r"\bat\b|[(\[]at", text, re.I) is not None, digit or ":" in text, digit)
    overlapping = _overlaps(good)
    for g, pattern in enumerate(GENERATORS):
        found = () if not there[g] else _addresses(text, _AT_HIT, _SOFT_HOST, _NAME_START) if g == 0 else (m.span() for m in pattern.finditer(text))
        for s, e in found:
            if g == 0:
                e = s + _mail_end(text[s:e])
            over = overlapping(s, e)
            if over and not over & set(OF[g]):
                continue
            label = 1 if over else _label(text, g, s, e)
            out.append({"k": g, "s": s, "e": e, "label": label, "free": not over, "f": features(text, g, s, e)})
    return out


def _label(text: str, g: int, s: int, e: int) -> int | None:
    """0 if a candidate fails the check of the kind that its own format claims, 1 for a number of 7 to 12 digits
    after a phone cue word, none where the format leaves it open (national phone numbers without a cue)."""
    x = text[s:e]
    d = _digits(x)
    if g == 0:
        return None if _tld(x) else 0
    if re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", x):
        return None if _octets(x.split(".")) else 0
    if g == 1:
        return None
    if x[0] == "+":
        return None if 9 <= len(d) <= 15 else 0
    if DATE.fullmatch(x):
        return 0
    if len(d) >= 13:
        return None if x.startswith("00") or len(d) <= 19 and luhn(d) else 0
    if PHONE_CUE.search(text[max(0, s - 25):s]):
        return 1
    return 0 if x.isdigit() and x[0] != "0" else None


def taught(text: str, good) -> list[dict]:
    """Labelled examples made from the base spans, for formats that no base pattern has; they are only learnt from.

    An address, and words before it in place of its name and host, are written in another way where it stands
    (label 1), and the same with an end that is no mail-like domain (label 0); the ways follow from a hash.
    A phone number is written without its country code in a national grouping (label 1), and its digits as a
    date and, away from phone cue words, as one run of digits (label 0).
    """
    out = []

    def add(g, label, before, written, after, s):
        m = GENERATORS[g].search(written)
        if m and m.span() == (0, len(written)):
            text = before + written + after
            out.append({"k": g, "s": s, "e": s, "label": label, "free": False, "f": features(text, g, len(before), len(before) + len(written))})

    for kind, s, e in good:
        before, after, x = text[max(0, s - 40):s], text[e:e + 1], text[s:e]
        h = zlib.crc32(f"{s} {x}".encode())
        if kind == "email":
            name, domain = x.split("@", 1)
            at, dot = _ATS[h % len(_ATS)], _DOTTED[h // 16 % len(_DOTTED)]
            host, last = domain.rsplit(".", 1)
            words = re.findall("[A-Za-z]{2,}", text[max(0, s - 200):s])[-3:]
            own = [(name.lstrip("._%+-"), host)] + [tuple(words[:2])] * (len(words) == 3)
            if (at, dot) == ("@", "."):
                at = " at "
            for name, host in own:  # names of both sorts in both classes, so that the format decides and not the name
                add(0, 1, before, name + at + host.replace(".", dot) + dot + last, after, s)
                if len(words) == 3 and not _tld(words[2]):
                    add(0, 0, before, name + _PROSE_ATS[h // 256 % 4] + host + _PROSE_DOTS[h // 1024 % 4] + words[2], after, s)
        elif kind == "phone":
            d = _digits(re.sub(r"^\+(?:1|[0-9]{2})", "", x))
            if 8 <= len(d) <= 12:
                a, b, c = d[:3], d[3:-4], d[-4:]
                forms = (f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"0{a} {b}{c}", f"0{a}/{b}{c}", f"0{a}-{b}{c}", f"(0{a}) {b} {c}")
                add(2, 1, before, forms[h % 8], after, s)
                year, month, day = 1950 + h % 80, 1 + h // 80 % 12, 1 + h // 960 % 28
                add(2, 0, before, (f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month:02}/{day:02}/{year}",
                                   f"{year}-{month:02}-{day:02} {h % 24:02}")[h // 7 % 4], after, s)
                if not PHONE_CUE.search(before) and d[0] != "0":
                    add(2, 0, before, d, after, s)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, cand, taught): the base spans, all candidates and the examples made of every text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    cand = pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("label", pa.int32()), ("free", pa.bool_()), ("f", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            base, cands, made = [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                good = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in good])
                cands.append(candidates(text, good))
                made.append(taught(text, good))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(cands, pa.list_(cand)), pa.array(made, pa.list_(cand))],
                                             names=["doc_id", "base", "cand", "taught"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base array<struct<kind:string,start:int,end:int>>, "
                                "cand array<struct<k:int,s:int,e:int,label:int,free:boolean,f:array<double>>>, "
                                "taught array<struct<k:int,s:int,e:int,label:int,free:boolean,f:array<double>>>")


def _tree(node, f: Column) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[int(split.featureIndex())] <= float(split.threshold()), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


class Boosted:
    """Boosted trees as a Spark column, with a threshold on their probability for each generator."""

    def __init__(self, model=None, cut: dict[int, float] | None = None):
        self.model, self.cut = model, cut or {}

    def probability(self, f: Column) -> Column:
        total = F.lit(0.0)
        for tree, weight in zip(self.model.trees, self.model.treeWeights):
            total = total + _tree(tree._java_obj.rootNode(), f) * float(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * total))

    def selects(self, c: Column) -> Column:
        out = F.lit(False)
        if self.model is not None:
            p = self.probability(c["f"])
            for g, t in sorted(self.cut.items()):
                out = out | ((c["k"] == g) & (p >= t))
        return out


def fit(cands: DataFrame, task_rows: int = 8000, precision: float = 0.98, rounds: int = 10) -> Boosted:
    """Learn from all labelled candidates (doc_id, k, s, label, f), dealt to tasks of about ``task_rows`` by a hash.

    A generator whose labelled candidates are all of one class cannot be calibrated and selects nothing.
    Three quarters grow the trees; the rest sets, for each generator, the smallest probability (to six places), at least one
    half, from which on a share ``precision`` of the candidates is personal data.  A generator without such a threshold
    selects nothing.  With one class only, nothing is selected.
    """
    hashed = F.pmod(F.xxhash64("doc_id", "s", "k"), F.lit(1 << 20))
    labelled = save(cands.where("label is not null").select("k", "label", hashed.alias("h"), "f"), "pii-labelled")
    tasks = max(1, -(-labelled.count() // task_rows))
    grow = labelled.where("h % 4 != 0").repartition(tasks, "h").sortWithinPartitions("h", "f", "label")
    grow = save(grow.select(array_to_vector("f").alias("x"), F.col("label").cast("double").alias("y")), "pii-grow")
    if grow.select("y").distinct().count() < 2:
        return Boosted()
    boosted = Boosted(GBTClassifier(featuresCol="x", labelCol="y", maxDepth=3, maxIter=rounds, stepSize=0.3, seed=7).fit(grow))
    # Rows of one probability count together: at most a million steps per generator.
    held = labelled.where("h % 4 = 0").select("k", "label", F.round(boosted.probability(F.col("f")), 6).alias("p"))
    steps = held.groupBy("k", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right"))
    down = Window.partitionBy("k").orderBy(F.col("p").desc())
    steps = steps.select("k", "p", F.sum("n").over(down).alias("n"), F.sum("right").over(down).alias("right"), F.lead("p", 1, 0.0).over(down).alias("after"))
    both = labelled.groupBy("k").agg(F.count_distinct("label").alias("classes")).where("classes = 2").select("k")
    last = steps.where(F.col("right") >= F.lit(precision) * F.col("n")).groupBy("k").agg(F.min_by((F.col("p") + F.col("after")) / 2, "p").alias("cut"))
    return Boosted(boosted.model, {r.k: max(0.5, r.cut) for r in last.join(both, "k", "left_semi").orderBy("k").collect()})  # one row per generator


def pii(docs: DataFrame, task_rows: int = 8000, precision: float = 0.98, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base and found (arrays of kind, start, end).

    Positions count code points; ends are exclusive.  Base spans follow fixed patterns and checks and are
    always found.  The generators' candidates that overlap no base span are scored by boosted trees, learnt
    from the candidates whose label the checks give and examples made from base spans, and added (kinds SOFT) from a calibrated probability on.

    Null and empty texts have no spans.  Null ids are carried along and repeated rows repeat their result.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = save(scan(docs, id_col, text_col), "pii")
    boosted = fit(rows.select("doc_id", F.explode(F.concat("cand", "taught")).alias("c")).select("doc_id", "c.k", "c.s", "c.label", "c.f"), task_rows, precision)
    free = F.filter("cand", lambda c: c["free"] & boosted.selects(c))
    names = F.array(*map(F.lit, SOFT))
    soft = F.transform(F.array_sort(F.transform(free, lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))),
                       lambda c: F.struct(names[c["k"]].alias("kind"), c["s"].alias("start"), c["e"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(count, KINDS), "base", F.concat("base", soft).alias("found"))


def redact(text: str, found) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans count as one, named by the first."""
    out, at = [], 0
    for s, e, kind in sorted((x["start"], x["end"], x["kind"]) for x in found):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join(out) + text[at:]
