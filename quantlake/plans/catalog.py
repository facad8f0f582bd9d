"""Registry of named queries: a Spark callable plus its DuckDB oracle SQL.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables.  The oracle SQL (when given) runs on DuckDB views with the
same table names; column names match the Spark result exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from quantlake.plans import (q_quality, q_promote, q_reconcile, q_layout,  # noqa: F401
                                 q_ingest, q_temporal, q_panel, q_stream, q_nulls)
    return REGISTRY
