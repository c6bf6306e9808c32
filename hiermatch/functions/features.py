"""Structured feature extraction (F1-F4, F8) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Material flags (vector positions 1-7), matched on lower-cased text:
MATERIALS = (
    ("stainless_steel", r"\b(ss|stainless steel|304|316)\b"),
    ("carbon_steel", r"\b(cs|carbon steel|mild steel)\b"),
    ("pvc", r"\b(pvc|polyvinyl chloride)\b"),
    ("copper", r"\b(copper|cu)\b"),
    ("aluminum", r"\b(aluminum|al)\b"),
    ("galvanized", r"\b(galvanized|hdg|hot dip)\b"),
    ("brass", r"\b(brass)\b"),
)
# Specs (positions 8-15 as flag, value pairs), case-insensitive, first match:
SPECS = (
    ("volume", r"(\d+(?:\.\d+)?)\s*(?:gal|gallon|liter|l|ml|cc)"),
    ("pressure", r"(\d+(?:\.\d+)?)\s*(?:psi|bar|pa|kpa)"),
    ("power", r"(\d+(?:\.\d+)?)\s*(?:kw|hp|kbtu|btu|w|watt)"),
    ("voltage", r"(\d+(?:\.\d+)?)\s*(?:v|volt|ac|dc)"),
)
# Keyword flags (positions 16-21): any listed substring of the lower-cased text.
KEYWORDS = (
    ("heating", ("heater", "heating", "furnace", "boiler")),
    ("cooling", ("cooler", "cooling", "chiller", "fan")),
    ("pipe", ("pipe", "piping", "tubing", "coupling", "fitting")),
    ("valve", ("valve", "vlv", "gate", "check")),
    ("electrical", ("electrical", "wire", "cable", "panel")),
    ("plumbing", ("plumbing", "toilet", "sink", "faucet")),
)
# Dimension pair, declared by the reference but never applied.
DIMENSION = r"(\d+(?:\.\d+)?)\s*(?:x|by|×)\s*(\d+(?:\.\d+)?)"
# ---------------------------------------------------------------------------

FEATURE_NAMES = (
    [name for name, _ in MATERIALS]
    + [f"{name}{suffix}" for name, _ in SPECS for suffix in ("_flag", "_value")]
    + [f"kw_{name}" for name, _ in KEYWORDS]
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def material_flags(c) -> list[Column]:
    """F1: 7 doubles, 1.0 when the pattern occurs in the lower-cased text."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    return [low.rlike(p).cast("double").alias(n) for n, p in MATERIALS]


def spec_values(c) -> list[Column]:
    """F2: for each spec a flag and the first numeric value (0.0 when absent)."""
    x = F.coalesce(_col(c), F.lit(""))
    out = []
    for n, p in SPECS:
        g = F.regexp_extract(x, "(?i)" + p, 1)
        out.append((g != "").cast("double").alias(f"{n}_flag"))
        out.append(F.coalesce(g.try_cast("double"), F.lit(0.0)).alias(f"{n}_value"))
    return out


def keyword_flags(c) -> list[Column]:
    """6 doubles, 1.0 when any listed word is a substring of the lower-cased text."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    out = []
    for n, words in KEYWORDS:
        cond = F.lit(False)
        for w in words:
            cond = cond | low.contains(w)
        out.append(cond.cast("double").alias(f"kw_{n}"))
    return out


def feature_columns(c) -> list[Column]:
    """F1 + F2 + F3 as 21 named columns in vector order."""
    return material_flags(c) + spec_values(c) + keyword_flags(c)


def feature_vector(c) -> Column:
    """the 21 features as array<double> in fixed order."""
    # Each spec is searched for once, wherever the vector is used: Spark shares no work inside conditions or aggregates.
    found = F.array(*[F.regexp_extract(F.coalesce(_col(c), F.lit("")), "(?i)" + p, 1) for _, p in SPECS])
    specs = F.flatten(F.transform(found, lambda g: F.array((g != "").cast("double"), F.coalesce(g.try_cast("double"), F.lit(0.0)))))
    return F.concat(F.array(*material_flags(c)), specs, F.array(*keyword_flags(c)))


def dimensions(c) -> list[Column]:
    """F8: first dimension pair (a, b) or nulls."""
    x = F.coalesce(_col(c), F.lit(""))
    a = F.regexp_extract(x, "(?i)" + DIMENSION, 1)
    b = F.regexp_extract(x, "(?i)" + DIMENSION, 2)
    return [
        F.when(a != "", a.try_cast("double")).alias("dim_a"),
        F.when(b != "", b.try_cast("double")).alias("dim_b"),
    ]


def feature_similarity(p: Column, c: Column) -> Column:
    """1 - |p - c| / (1 + |p| + |c|) over two array<double>; null c -> zero vector."""
    zero = F.array_repeat(F.lit(0.0), F.size(p))
    cc = F.coalesce(c, zero)

    def norm(v):
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))

    diff = F.zip_with(p, cc, lambda a, b: a - b)
    return F.lit(1.0) - norm(diff) / (F.lit(1.0) + norm(p) + norm(cc))
