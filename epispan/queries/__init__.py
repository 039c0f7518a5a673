"""Registered queries: every operator run over the driver's tables, with its SQL check."""

from .registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
