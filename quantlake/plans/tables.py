"""Access to the driver's tables and the stand-in frames derived from them.

Stand-ins are declared once as SQL expression text (``DerivedFrame``), so the
Spark side (``selectExpr``) and the DuckDB oracle (a CTE) derive the same
input from the same words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class DerivedFrame:
    """``SELECT <cols> FROM <source> [WHERE <where>]`` usable from both engines."""
    name: str
    source: str                 # a driver table name
    cols: tuple[tuple[str, str], ...]
    where: str | None = None
    join: str | None = None     # optional second table, inner-joined ...
    on: str | None = None       # ... on this condition
    group_by: tuple[str, ...] = ()   # aliases in ``cols`` that are group keys; the rest aggregate

    def select_sql(self) -> str:
        body = ", ".join(f"{expr} AS {alias}" for alias, expr in self.cols)
        src = self.source if not self.join else f"{self.source} JOIN {self.join} ON {self.on}"
        sql = f"SELECT {body} FROM {src}"
        if self.where:
            sql += f" WHERE {self.where}"
        if self.group_by:
            exprs = dict(self.cols)
            sql += " GROUP BY " + ", ".join(exprs[g] for g in self.group_by)
        return sql

    def cte(self) -> str:
        return f"{self.name} AS ({self.select_sql()})"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        src = self._source_frame(spark, sf_dir)
        if self.where:
            src = src.where(F.expr(self.where))
        if self.group_by:
            keys = [F.expr(e).alias(a) for a, e in self.cols if a in self.group_by]
            aggs = [F.expr(e).alias(a) for a, e in self.cols if a not in self.group_by]
            if not aggs:
                return src.select(*keys).distinct()
            return src.groupBy(*keys).agg(*aggs).select(*[a for a, _ in self.cols])
        return src.selectExpr(*[f"{expr} AS {alias}" for alias, expr in self.cols])

    def _source_frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        src = table(spark, sf_dir, self.source)
        if self.join:
            src = src.join(table(spark, sf_dir, self.join), F.expr(self.on))
        return src


def with_ctes(*frames: DerivedFrame, body: str, extra: str | None = None) -> str:
    """``WITH <frames>[, <extra CTEs>] <body>`` for the DuckDB oracle."""
    ctes = [f.cte() for f in frames] + ([extra] if extra else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body
