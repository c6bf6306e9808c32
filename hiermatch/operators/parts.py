"""The classifier's replaceable parts: text cleaner, embedder, pair model and feature extractor.

Cleaner and extractor are Column -> Column and stay in the JVM.  Embedder and pair model are jobs: a :class:`Model`
says how a Python worker loads it, and texts travel to it as Arrow batches; a worker loads a model once, however many
tasks it runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.embed import DIM, hash_embed
from ..functions.features import feature_vector
from ..functions.text import clean, tokens
from . import rank, vectors

_LOADED: dict[str, Callable] = {}


@dataclass(frozen=True)
class Model:
    """``load()`` gives the callable that does the work; ``name`` tells models of one session apart."""
    name: str
    load: Callable[[], Callable]

    def __call__(self) -> Callable:
        """The callable, loaded once in this Python worker."""
        if self.name not in _LOADED:
            _LOADED[self.name] = self.load()
        return _LOADED[self.name]


@dataclass(frozen=True)
class Parts:
    """What :func:`classify.prebuild` and :func:`classify.classify_batch` take their text work from; the defaults are
    the built-in column forms.

    ``embedder.load()`` returns ``encode(list[str]) -> array (n, dim)``; query texts come cleaned, catalog texts raw.
    ``pair_model.load()`` returns ``score(list[str], list[str]) -> array (n,)`` of raw descriptions and catalog texts.
    ``extractor`` gives an array of doubles of one length.
    """
    cleaner: Callable[[Column], Column] = clean
    embedder: Model | None = None
    dim: int = DIM
    pair_model: Model | None = None
    extractor: Callable[[Column], Column] = feature_vector

    def tokens(self, c) -> Column:
        """The token list that lexical retrieval indexes and looks up."""
        return tokens(self.cleaner(F.col(c) if isinstance(c, str) else c))

    def embedded(self, df: DataFrame, id_col: str, text_col: str, out_id: str, text: Callable[[Column], Column]) -> DataFrame:
        """(out_id, embedding) of the ``text`` of every row."""
        # Dealt by id first: one unsplit file is still embedded by many tasks.
        rows = df.select(F.col(id_col).alias(out_id), F.col(text_col).alias("text")).repartition(out_id).withColumn("text", text(F.col("text")))
        if self.embedder is None:
            return rows.select(out_id, hash_embed("text", self.dim).alias("embedding"))
        return vectors.embed_with(rows, "text", "embedding", self.embedder, self.dim).drop("text")

    def queries(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self.embedded(df, id_col, text_col, "query_id", self.cleaner)

    def catalog(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self.embedded(df, id_col, text_col, "doc_id", lambda c: c)

    def pair_scores(self, cands: DataFrame) -> DataFrame:
        """``cands`` (query_id, doc_id, description, corpus, _q_tokens, doc_tokens, ...) with ``cross_score``."""
        if self.pair_model is None:
            return cands.withColumn("cross_score", rank.token_cosine(F.col("_q_tokens"), F.col("doc_tokens")))
        scored = cands.withColumn("_cross", rank.pair_score_column(self.pair_model)("description", "corpus"))
        # Rows that share both ids have the scores of all of these; the ids are not shuffled, as candidates lie by query.
        scored = scored.withColumn("_all", F.collect_list("_cross").over(Window.partitionBy("query_id", "doc_id")))
        return scored.withColumn("cross_score", F.explode("_all")).drop("_cross", "_all")
