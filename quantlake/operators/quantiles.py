"""Exact per-group percentiles that do not gather a large group into one task.

Spark's ``percentile``/``median`` aggregate holds every value of a group in
one task's memory, so a group with a third of all rows would sit on one
executor.  Here the values of a group are counted by bins of their logarithm first (a partial
aggregate, 64 bins an octave), which tells the bin or two that hold the ranks to interpolate
between; only values of these bins go on, except in groups of few values or beyond ``HELD``
groups, which go on whole.  There equal values are counted, and a running count over the
distinct values in their order, an :func:`~quantlake.operators.scan.ordered_scan` that cuts
a large group into value ranges, tells the two values.  It is one lazy plan of a fixed
number of steps: nothing runs while it is built.

The result equals SQL ``percentile_cont`` / DuckDB ``median``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.operators.scan import ordered_scan


#: Groups whose bins are looked up at most (they are broadcast), and the values that such a group has at least.
HELD, MANY = 20_000, 10_000


def _bin(x: Column) -> Column:
    """A whole number that never falls as ``x`` grows: 64 an octave on each side of zero."""
    size = F.floor((F.log2(F.abs(x)) + F.lit(1076.0)) * F.lit(64.0))
    return F.when(x > 0, size).when(x < 0, -size).when(x == 0, F.lit(0).cast("long"))


def _picked_bins(x: DataFrame, p: float) -> tuple[DataFrame, DataFrame]:
    """(ranks, held): ``_lo``, ``_hi`` and ``_frac`` of every group with a value; the bins of the ranks, and how many
    values lie before them, of the largest groups."""
    bins = x.groupBy("_g", _bin(F.col("_x")).alias("_bin")).agg(F.count("_x").alias("_m"))
    sizes = bins.groupBy("_g").agg(F.sum("_m").alias("_n"), F.sort_array(F.collect_list(F.when(F.col("_m") > 0, F.struct("_bin", "_m")))).alias("_bins"))
    pos = (F.col("_n") - 1) * F.lit(float(p))                 # 0-based and fractional
    sizes = sizes.where("_n > 0").select("_g", "_n", "_bins", F.floor(pos).alias("_lo"), F.ceil(pos).alias("_hi"), (pos - F.floor(pos)).alias("_frac"))

    def place(rank: str) -> Column:
        """The bin of a rank and the count before it."""
        start = F.struct(F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("before"), F.lit(False).alias("found"))
        return F.aggregate("_bins", start, lambda a, b: F.when(a["found"], a).when(
            a["before"] + b["_m"] > F.col(rank), F.struct(b["_bin"].alias("bin"), a["before"].alias("before"), F.lit(True).alias("found")))
            .otherwise(F.struct(b["_bin"].alias("bin"), (a["before"] + b["_m"]).alias("before"), F.lit(False).alias("found"))))

    held = (sizes.where(F.col("_n") >= MANY).orderBy(F.col("_n").desc(), "_g").limit(HELD)
            .select("_g", place("_lo").alias("_l"), place("_hi").alias("_h"))
            .select("_g", F.col("_l.bin").alias("_bin_lo"), F.col("_l.before").alias("_before_lo"),
                    F.col("_h.bin").alias("_bin_hi"), F.col("_h.before").alias("_before_hi")))
    return sizes.select("_g", "_lo", "_hi", "_frac"), held


def exact_percentile(df: DataFrame, col: str, by: Sequence[str] | str | None = None, p: float = 0.5,
                     name: str | None = None, bucket="auto") -> DataFrame:
    """Interpolated percentile of ``col`` per group (NULL/NaN dropped).

    Returns one row per group with at least one value: ``by... , name``.
    ``bucket`` is that of :func:`~quantlake.operators.scan.ordered_scans`.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    name = name or f"p{int(round(p * 100))}_{col}"
    # the group is one struct: it is never NULL, and a NULL group value equals itself in every join
    names = by or ["_all"]
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)]) if by else F.struct(F.lit(0).alias("g0"))
    own = F.col(col).cast("double")
    # no filter here: the values' exchanges stay those of the caller's other aggregates
    x = df.select(group.alias("_g"), F.when(~F.isnan(own), own).alias("_x"))
    ranks, held = _picked_bins(x, p)
    j = x.join(F.broadcast(held.withColumnRenamed("_g", "_held")), F.col("_g") == F.col("_held"), "left")
    bin_ = _bin(F.col("_x"))
    # one condition as a whole, so that no part of it moves below the caller's exchanges
    j = j.where(F.when(F.col("_x").isNull(), F.lit(False)).when(F.col("_held").isNull(), F.lit(True)).otherwise((bin_ == F.col("_bin_lo")) | (bin_ == F.col("_bin_hi"))))
    # the part of a group that is looked through: all of it, or one of its two bins
    part = F.when(F.col("_held").isNull(), 0).when(bin_ == F.col("_bin_lo"), 1).otherwise(2)
    before = F.when(part == 2, F.col("_before_hi")).otherwise(F.coalesce("_before_lo", F.lit(0)))
    values = j.select("_g", part.alias("_part"), before.cast("long").alias("_before"), "_x").groupBy("_g", "_part", "_before", "_x").agg(F.count(F.lit(1)).alias("_k"))
    run = ordered_scan(values, ["_g", "_part"], ["_x"], "_k", "sum", "_end", bucket=bucket).withColumn("_end", F.col("_end") + F.col("_before"))
    inside = lambda rank: (rank >= F.col("_end") - F.col("_k")) & (rank < F.col("_end"))
    j = run.join(ranks, "_g").withColumns({"_at_lo": inside(F.col("_lo")), "_at_hi": inside(F.col("_hi"))})
    picked = j.where("_at_lo OR _at_hi").groupBy("_g").agg(
        F.max(F.when(F.col("_at_lo"), F.col("_x"))).alias("_lo"), F.max(F.when(F.col("_at_hi"), F.col("_x"))).alias("_hi"), F.max("_frac").alias("_frac"))
    val = F.when(F.col("_frac") == 0, F.col("_lo")) \
        .otherwise(F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo")))
    return picked.select(*[F.col(f"_g.g{i}").alias(c) for i, c in enumerate(names) if by], val.alias(name))


def exact_median(df: DataFrame, col: str, by: Sequence[str] | str | None = None,
                 name: str | None = None, **kw) -> DataFrame:
    return exact_percentile(df, col, by, 0.5, name or f"median_{col}", **kw)
