"""Registered query plans (Spark) and their DuckDB oracle text."""

from . import q_classify, q_evaluate, q_retrieval, q_sinks, q_static, q_training  # noqa: F401  (registers queries)
from .registry import ORACLES, QUERIES  # noqa: F401
