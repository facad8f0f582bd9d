"""Two-source price reconciliation (vendor A vs vendor B).

Data stay long: one DataFrame with a ``contract`` column, one join on
``(contract, date)`` for all contracts and one grouped aggregate — never a
Python loop over per-contract frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.operators.quantiles import exact_median
from quantlake.operators.joins import broadcast_if_small
from quantlake.operators.quality import histogram  # noqa: F401  (re-exported: D14)

# fixed values: tolerances used by the reconciliation report (price units)
TOL_EXACT = 0.005
TOL_CLOSE = 0.10
OUTLIER_THRESHOLD = 0.50


def align(a: DataFrame, b: DataFrame, mapping: DataFrame | None = None,
          a_code: str = "contract", b_code: str = "ric", on: str = "date",
          max_mapping_bytes: int | None = None) -> DataFrame:
    """Join source A and B on (contract, date), A's codes mapped to B's.

    ``mapping`` (contract → ric) is a code list.  Pass ``max_mapping_bytes``
    for a stored mapping table to broadcast it after a size check; by default
    AQE decides at run time.  Without a mapping both sides share ``a_code``.
    """
    if mapping is not None:
        a = a.join(broadcast_if_small(mapping, max_mapping_bytes), a_code, "inner")
        return a.join(b, [b_code, on], "inner")
    return a.join(b, [a_code, on], "inner")


def side_counts(a: DataFrame, b: DataFrame, mapping: DataFrame, a_code: str = "contract",
                b_code: str = "ric", on: str = "date") -> DataFrame:
    """Rows in A, rows in B and matched rows per contract (grouped counts joined)."""
    ca = a.groupBy(a_code).agg(F.count(F.lit(1)).alias("a_rows"))
    cb = b.groupBy(b_code).agg(F.count(F.lit(1)).alias("b_rows"))
    m = align(a.select(a_code, on), b.select(b_code, on), mapping, a_code, b_code, on)
    cm = m.groupBy(a_code).agg(F.count(F.lit(1)).alias("matched_rows"))
    return (mapping.join(ca, a_code, "left").join(cb, b_code, "left").join(cm, a_code, "left")
              .select(a_code, b_code,
                      F.coalesce("a_rows", F.lit(0)).alias("a_rows"),
                      F.coalesce("b_rows", F.lit(0)).alias("b_rows"),
                      F.coalesce("matched_rows", F.lit(0)).alias("matched_rows")))


def unmatched_codes(mapping: DataFrame, b: DataFrame, b_code: str = "ric") -> DataFrame:
    """Mapped codes with no rows at all in source B."""
    return mapping.join(b.select(b_code).distinct(), b_code, "left_anti")


def _rate(d: Column, tol: float) -> Column:
    # NaN/NULL differences count as non-matches in the denominator
    return F.avg(F.coalesce(F.abs(d) < F.lit(tol), F.lit(False)).cast("double"))


def reconcile_summary(m: DataFrame, price: str = "a_price", others: Sequence[str] = ("b_last", "b_settle"),
                      labels: Sequence[str] = ("last", "settle"), by: str = "contract",
                      tol_exact: float = TOL_EXACT, tol_close: float = TOL_CLOSE, digits: int = 4,
                      code: str | None = None) -> DataFrame:
    """Per contract, for each B field: mean, median, max |diff|, exact and close rates.

    ``code`` names the other vendor's code column, kept beside the contract.

    The differences are unpivoted to ``(contract, field, d)`` so every
    statistic — the exact median included — is one grouped pass for all
    fields; the small result is pivoted back to one row per contract.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(l).alias("_f"), (F.col(price) - F.col(o)).alias("_d"))
                                for o, l in zip(others, labels)]))
    keys = [by, *([code] if code else [])]
    d = m.select(*keys, cells.alias("_c")).select(*keys, "_c._f", "_c._d")
    c = F.col("_d")
    stats = d.groupBy(*keys, "_f").agg(F.count(F.lit(1)).alias("_n"), F.avg(c).alias("_mean"),
                                    F.max(F.abs(c)).alias("_maxabs"),
                                    _rate(c, tol_exact).alias("_exact"), _rate(c, tol_close).alias("_close"))
    med = exact_median(d, "_d", [*keys, "_f"], "_median")
    group = F.struct(*[F.col(k).alias(f"g{i}") for i, k in enumerate([*keys, "_f"])])      # NULL-safe
    long = stats.withColumn("_g", group).join(med.select(group.alias("_g"), "_median"), "_g", "left")
    exprs = [F.max("_n").alias("n_matched")]
    for l in labels:
        pick = lambda col: F.max(F.when(F.col("_f") == l, F.col(col)))
        exprs += [F.round(pick("_mean"), digits).alias(f"vs_{l}_mean_diff"),
                  F.round(pick("_median"), digits).alias(f"vs_{l}_median_diff"),
                  F.round(pick("_maxabs"), digits).alias(f"vs_{l}_max_abs_diff"),
                  F.round(pick("_exact"), digits).alias(f"vs_{l}_exact_pct"),
                  F.round(pick("_close"), digits).alias(f"vs_{l}_close_pct")]
    return long.groupBy(*keys).agg(*exprs)


def outliers(m: DataFrame, price: str = "a_price", others: Sequence[str] = ("b_last", "b_settle"),
             threshold: float = OUTLIER_THRESHOLD, keep: Sequence[str] = ("contract", "date")) -> DataFrame:
    """Days where every B field differs from A by more than ``threshold``."""
    diffs = {f"diff_{o}": F.col(price) - F.col(o) for o in others}
    out = m.withColumns(diffs)
    cond = None
    for name in diffs:
        c = F.abs(F.col(name)) > F.lit(threshold)
        cond = c if cond is None else cond & c
    return out.where(cond).select(*keep, price, *others, *diffs.keys())


def series(m: DataFrame, cols: Sequence[str], by: str = "contract", on: str = "date") -> DataFrame:
    """The aligned series table, ordered by contract and date (for plotting elsewhere)."""
    return m.select(by, on, *cols).orderBy(by, on)


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pooled Pearson correlation matrix, pairwise-complete, long form.

    One aggregate computes every pair; the result is unpivoted into
    ``(var1, var2, corr)`` rows.
    """
    pairs = [(a, b) for a in cols for b in cols]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                         F.round(F.col(f"{a}__{b}"), digits).alias("corr"))
                                for a, b in pairs]))
    return agg.select(cells.alias("_c")).select("_c.var1", "_c.var2", "_c.corr")
