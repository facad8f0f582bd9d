"""Split adjustment: cumulative split factors and (un)adjusting values.

unadjusted = adjusted × ∏ ADJ over splits of the ticker dated strictly after
the value's date.  The suffix product is an ordered scan over the split table
(split into buckets like every other, so no ticker is one task), attached
to each value by a forward as-of join: no row × split fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.operators.asof import asof_join
from quantlake.operators.scan import ordered_scan


def split_factor(splits: DataFrame, on: Sequence[str], date: str, adj: str,
                 tie_break: Sequence[str] = (), bucket="auto") -> DataFrame:
    """Per split row, the product of its own and all later factors (``cum_adj``).

    A NULL factor counts as 1; a zero makes the product zero.
    """
    on = list(on)
    d = splits.select(*on, F.col(date).alias("_split_date"), *tie_break, F.col(adj).cast("double").alias("_adj"))
    d = ordered_scan(d, on, ["_split_date", *tie_break], "_adj", "product", "cum_adj", descending=True, bucket=bucket)
    return d.withColumn("cum_adj", F.coalesce("cum_adj", F.lit(1.0))).drop("_adj")


def _factor(df: DataFrame, splits: DataFrame, on: Sequence[str], at: str, date: str, adj: str,
            tie_break: Sequence[str]) -> DataFrame:
    f = split_factor(splits, on, date, adj, tie_break)
    # first split strictly after the value's date carries the product of it and all later splits
    j = asof_join(df, f.select(*on, "_split_date", "cum_adj", *tie_break), on, at, "_split_date",
                  ["cum_adj"], strict=True, direction="forward", tie_break=tie_break)
    return j.withColumn("cum_adj", F.coalesce(F.col("cum_adj"), F.lit(1.0)))


def unadjust(df: DataFrame, splits: DataFrame, on: Sequence[str], at: str, cols: Sequence[str],
             date: str = "SPDATES", adj: str = "ADJ", tie_break: Sequence[str] = ()) -> DataFrame:
    """Split-adjusted values → as originally reported (× later factors)."""
    j = _factor(df, splits, on, at, date, adj, tie_break)
    return j.withColumns({c: F.col(c) * F.col("cum_adj") for c in cols})


def adjust(df: DataFrame, splits: DataFrame, on: Sequence[str], at: str, cols: Sequence[str],
           date: str = "SPDATES", adj: str = "ADJ", tie_break: Sequence[str] = ()) -> DataFrame:
    """Reported values → split-adjusted (÷ later factors)."""
    j = _factor(df, splits, on, at, date, adj, tie_break)
    return j.withColumns({c: F.col(c) / F.col("cum_adj") for c in cols})
