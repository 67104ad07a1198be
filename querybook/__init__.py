"""Registered queries: each operator on the given tables, with SQL to check it."""

from querybook import chain, cleaning, joins, kpis, learning, marts, quality, scalars, scores, storage
from querybook.book import oracle_sql, queries

__all__ = [
    "chain",
    "cleaning",
    "joins",
    "kpis",
    "learning",
    "marts",
    "oracle_sql",
    "quality",
    "queries",
    "scalars",
    "scores",
    "storage",
]
