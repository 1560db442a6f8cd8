"""Registered queries and their oracle SQL."""

from . import atlas_queries, table_queries, text_queries  # noqa: F401
from .registry import registry

__all__ = ["registry"]
