"""Built-in text embedder (R4 default): hashed bag of tokens, L2-normalised.

Tokens and their buckets are Column expressions; the counts of a whole Arrow batch are one vectorised bin
count.  A learned model plugs in through :func:`hiermatch.operators.vectors.embed_with` (``mapInPandas``)
instead.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

DIM = 64


def embed_tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(F.coalesce(col, F.lit(""))), "[^a-z0-9]+"), lambda t: t != "")


def bucket(t: Column, dim: int) -> Column:
    """Stable token bucket: first 16 bits of md5 modulo ``dim`` (same value in Spark and DuckDB)."""
    return F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int") % F.lit(dim)


def hash_counts(c, dim: int = DIM, tokenizer=embed_tokens) -> Column:
    """Raw bucket counts as array<double> of length ``dim``."""
    return _counter(dim)(F.transform(tokenizer(c), lambda t: bucket(t, dim)))


def _counter(dim: int, unit: bool = False):
    @F.pandas_udf(ArrayType(DoubleType()))
    def counts(buckets: pd.Series) -> pd.Series:
        size = buckets.str.len().to_numpy(np.int64) if len(buckets) else np.zeros(0, np.int64)
        flat = np.concatenate([*buckets, np.zeros(0, np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(buckets)), size)
        v = np.bincount(row * dim + flat, minlength=len(buckets) * dim).reshape(-1, dim).astype(np.float64)
        if unit:
            v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-300)
        return pd.Series(list(v))

    return counts


def hash_embed(c, dim: int = DIM, tokenizer=embed_tokens) -> Column:
    """Unit-length hashed bag-of-tokens vector (all zeros for text without tokens)."""
    return _counter(dim, unit=True)(F.transform(tokenizer(c), lambda t: bucket(t, dim)))
