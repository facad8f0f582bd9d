"""Table re-layout: vertical split and rejoin, re-sort, drop derivable columns, audit.

The reference rewrote a 4-billion-row table one year at a time and split it
by column groups to bound memory.  Spark needs neither: column pruning and a
spilling sort handle the rewrite in one job.  ``vertical_split`` /
``vertical_join`` remain as user operators, and ``relayout_audit`` checks the
row count per year, because keys are not unique by constraint and a rejoin
on a duplicated key multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantlake.sources.sinks import write_clustered

# fixed values: Greek columns that are recomputable from implied volatility
GREEKS = ("delta", "gamma", "vega", "theta")


def vertical_split(df: DataFrame, key: Sequence[str], groups: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One frame per column group, each carrying the key."""
    return {name: df.select(*key, *cols) for name, cols in groups.items()}


def vertical_join(parts: Mapping[str, DataFrame] | Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Inner join of the column groups on the key (sort-merge on the key).

    When the parts come from one table that is already hash-partitioned on
    the key (or bucketed by it), the joins need no further exchange.
    """
    frames = list(parts.values()) if isinstance(parts, Mapping) else list(parts)
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, list(key), "inner")
    return out


def relayout_frame(df: DataFrame, drop: Sequence[str] = (), year_filter: Column | None = None) -> DataFrame:
    """The rows and columns a re-layout keeps (lazy; sorting happens in the writer)."""
    out = df.drop(*drop)
    return out.where(year_filter) if year_filter is not None else out


def relayout(df: DataFrame, path: str, sort: Sequence[str], drop: Sequence[str] = (),
             year_col: str | None = None, partitions: int | None = None) -> str:
    """Rewrite a table sorted by ``sort``, optionally partitioned by year.

    A ``year`` partition column keeps per-year restart and partition pruning.
    """
    out = df.drop(*drop)
    part = []
    if year_col:
        out = out.withColumn("year", F.year(year_col))
        part = ["year"]
    return write_clustered(out, path, sort, part, partitions)


def rejoin_audit(df: DataFrame, key: Sequence[str], year_col: str) -> DataFrame:
    """D17 ahead of a vertical split: rows per year before, and after a rejoin on ``key``; ``diff`` must be 0.

    Nothing is joined row by row: a key with N rows, n of them in a year, gives n * N
    rows of that year, so both figures are sums over counts per (key, year).
    """
    year = F.year(year_col).cast("int").alias("year")
    per = df.groupBy(*key, year).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*key)
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return (per.withColumn("_all", F.sum("n").over(whole))
            .groupBy("year").agg(F.sum("n").alias("rows_before"), F.sum(F.when(known, F.col("n") * F.col("_all")).otherwise(0)).alias("rows_after"))
            .withColumn("diff", F.col("rows_after") - F.col("rows_before")))


def relayout_audit(before: DataFrame, after: DataFrame, year_col: str) -> DataFrame:
    """Rows per year before and after; ``diff`` must be 0.

    Both counts are grouped aggregates (one row per year) joined on year.
    """
    b = before.groupBy(F.year(year_col).alias("year")).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(F.year(year_col).alias("year")).agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.join(a, "year", "full_outer")
             .select("year", F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
                     F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
             .withColumn("diff", F.col("rows_after") - F.col("rows_before"))
             .withColumn("year", F.col("year").cast("int")))
