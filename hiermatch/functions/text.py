"""Text scalars (T1-T8) as ``Column -> Column`` builders.

All of these compile to Catalyst expressions (whole-stage codegen); only the
NFKD step of :func:`name_key` needs Python, and only for non-ASCII rows.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Abbreviation map of the substring cleaner, applied in this order:
#   pvc -> polyvinyl chloride, ss -> stainless steel, cs -> carbon steel,
#   vlv -> valve, adpt -> adapter, bush -> bushing, cplg -> coupling,
#   ftg -> fitting, tee -> t-junction
ABBREVIATIONS = (
    ("pvc", "polyvinyl chloride"),
    ("ss", "stainless steel"),
    ("cs", "carbon steel"),
    ("vlv", "valve"),
    ("adpt", "adapter"),
    ("bush", "bushing"),
    ("cplg", "coupling"),
    ("ftg", "fitting"),
    ("tee", "t-junction"),
)
# Whole-token map of the token cleaner:
#   ss -> stainless steel, pvc -> polyvinyl chloride, vlv -> valve,
#   adpt -> adapter, bush -> bushing
TOKEN_MAP = (
    ("ss", "stainless steel"),
    ("pvc", "polyvinyl chloride"),
    ("vlv", "valve"),
    ("adpt", "adapter"),
    ("bush", "bushing"),
)
# ---------------------------------------------------------------------------

# What Python's str.isspace and the regex \\s of its str patterns take for blank; Java's \\s is ASCII only.
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Word characters of Python's str regex: letters, digits (incl. other numerics), underscore.
_NON_WORD = r"[^\p{L}\p{N}_]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def corpus(segment, family, klass, commodity) -> Column:
    """lower(segment + ' ' + family + ' ' + class + ' ' + commodity); any null part -> null."""
    sp = F.lit(" ")
    return F.lower(F.concat(_col(segment), sp, _col(family), sp, _col(klass), sp, _col(commodity)))


def strip(c) -> Column:
    """Without blanks of any kind at either end."""
    return F.regexp_replace(_col(c), f"^{SPACE}+|{SPACE}+$", "")


def join_key(c) -> Column:
    """Strip + lower (Python strip removes all edge whitespace, not only blanks)."""
    return F.lower(strip(c))


def clean(c, mapping=ABBREVIATIONS, drop_runs: int | None = None, drop_runs_mixed_case: bool = False) -> Column:
    """Lower, ordered unanchored substring replacement, keep [a-z0-9\\s], collapse blanks.

    ``drop_runs`` removes alphanumeric runs of at least that length after the mapping
    (T4).  With ``drop_runs_mixed_case`` the run class also admits upper case, which
    after lowering changes nothing but is kept for parity with that variant.
    Null input gives the empty string.
    """
    x = F.lower(F.coalesce(_col(c), F.lit("")))
    for src, dst in mapping:
        x = F.replace(x, F.lit(src), F.lit(dst))
    if drop_runs:
        cls = "a-zA-Z0-9" if drop_runs_mixed_case else "a-z0-9"
        x = F.regexp_replace(x, rf"\b[{cls}]{{{int(drop_runs)},}}\b", "")
    return F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))  # blanks and all that is not kept, in one pass


def clean_tokens(c, mapping=TOKEN_MAP) -> Column:
    """T5: lower, split on whitespace, map whole tokens, non-word chars -> space, collapse.

    Keeps ``_`` and non-ASCII letters (``[^\\w\\s]`` of Python's Unicode regex).
    """
    toks = F.filter(F.split(F.lower(F.coalesce(_col(c), F.lit(""))), f"{SPACE}+"), lambda t: t != "")
    m = F.create_map(*[F.lit(v) for kv in mapping for v in kv])
    mapped = F.transform(toks, lambda t: F.coalesce(F.element_at(m, t), t))
    x = F.array_join(mapped, " ")
    x = F.regexp_replace(x, r"[^\p{L}\p{N}_\s]", " ")
    x = F.regexp_replace(x, r"\s+", " ")
    return F.trim(x)


def with_clean(df, src: str, dst: str, cleaner=clean):
    """Apply a cleaner to one column and append the result."""
    return df.withColumn(dst, cleaner(F.col(src)))


@F.pandas_udf(StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKD", v))


def name_key(c) -> Column:
    """NFKD, runs of non-word characters -> one space, strip, lower.

    The Arrow UDF runs only for rows holding non-ASCII characters; ASCII rows
    stay in codegen.
    """
    x = _col(c)
    normalized = F.when(x.rlike(r"^[\x00-\x7F]*$"), x).otherwise(_nfkd(x))
    return F.lower(F.trim(F.regexp_replace(normalized, _NON_WORD, " ")))


def tokens(c) -> Column:
    """Whitespace tokenisation without empty tokens."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), f"{SPACE}+"), lambda t: t != "")


def clean_token_list(c, mapping=ABBREVIATIONS) -> Column:
    """T3 followed by T8: the token list retrieval indexes."""
    # Cleaned words stand between single blanks, so no pattern of blanks is needed.
    return F.filter(F.split(clean(c, mapping), " "), lambda t: t != "")
