"""The registered queries over the given tables, each with its SQL where SQL can say it."""

from tidemark.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
