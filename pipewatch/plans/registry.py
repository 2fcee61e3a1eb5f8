"""Registry of audit queries: each entry is a callable ``(spark, sf_dir) ->
DataFrame`` over the driver tables, and (when SQL can express it) the same
question as DuckDB SQL over the pre-registered driver views.

Column names are identical on both sides; doubles are rounded on both
sides; 128-bit sums are cast to BIGINT in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if any) to the registry."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _load_all() -> None:
    from pipewatch.plans import (  # noqa: F401
        catalog_audits,
        history_audits,
        item_audits,
        load_audits,
        schema_audits,
        stats_audits,
        stream_audits,
        topic_audits,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
