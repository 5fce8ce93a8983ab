"""Registered queries with their SQL twins."""

from . import metric_queries, model_queries, search_queries, table_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
