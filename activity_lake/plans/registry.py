"""The ``queries()`` / ``oracle_sql()`` registry (imported by ``__spark_entry__``).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole derived feed. Column names are aliased identically in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        OPERATORS[name] = ops
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    from . import q_core, q_gold, q_reports, q_quality, q_profile, q_io  # noqa: F401
