"""Operators of a training-data pipeline. ``queries()`` and ``oracle_sql()`` bind them to the
test tables; nothing else in the library imports this subpackage."""

from .queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
