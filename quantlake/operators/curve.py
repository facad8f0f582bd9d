"""Zero-curve interpolation and Greeks from implied volatility.

The rate for an expiry is read off the same day's curve: the nearest tenor
at or below and at or above the days to expiry, blended linearly, flat
beyond the first and last tenor.  The curve is turned into per-date tenor
segments once, and the options find their segment with one broadcast join.
Greeks use Black's model on the forward price with a polynomial normal CDF
(Spark has no ``erf``), so they stay JVM-side expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantlake.functions.scalars import cdf_t, cdf_tail, norm_pdf
from quantlake.operators.joins import broadcast_if_small


def curve_segments(curve: DataFrame, date: str = "date", days: str = "days", rate: str = "rate") -> DataFrame:
    """Each day's curve as tenor segments ``[lo_days, hi_days)`` with the rates at both ends.

    Segments run between consecutive tenors; the open segment before the
    first tenor and after the last carry that tenor's rate (flat ends).  The
    window is per date over the curve itself (a few dozen tenors a day).
    Tenors must be unique per date.
    """
    c = curve.select(F.col(date).alias("_d"), F.col(days).alias("_lo_days"), F.col(rate).alias("_lo_rate"))
    w = Window.partitionBy("_d").orderBy("_lo_days")
    c = c.withColumns({"_hi_days": F.lead("_lo_days").over(w), "_hi_rate": F.lead("_lo_rate").over(w),
                       "_first": F.row_number().over(w) == 1})
    inner = c.select("_d", "_lo_days", "_lo_rate", "_hi_days", "_hi_rate")
    # before the first tenor: flat at the first rate
    head = c.where("_first").select("_d", F.lit(None).cast("int").alias("_lo_days"), F.lit(None).cast("double").alias("_lo_rate"),
                                    F.col("_lo_days").alias("_hi_days"), F.col("_lo_rate").alias("_hi_rate"))
    return inner.unionByName(head)


def curve_rate(df: DataFrame, curve: DataFrame, date: str = "date", days: str = "dte",
               curve_date: str = "date", curve_days: str = "days", rate: str = "rate",
               out: str = "rate", max_curve_bytes: int | None = 256 << 20) -> DataFrame:
    """Linearly interpolated zero rate at ``days`` on ``date``; flat at the ends.

    One equi join on the date with the segment as a range condition: every
    row falls into exactly one segment, so there is no fan-out and no
    grouping.  The segment table (about one row per curve point) is
    broadcast when the plan's size estimate is at most ``max_curve_bytes``, so
    the (large) option side is then not shuffled.
    """
    seg = curve_segments(curve, curve_date, curve_days, rate)
    seg = broadcast_if_small(seg, max_curve_bytes)
    t = F.col(days)
    inside = (seg["_lo_days"].isNull() | (t >= seg["_lo_days"])) & (seg["_hi_days"].isNull() | (t < seg["_hi_days"]))
    j = df.join(seg, (df[date] == seg["_d"]) & inside, "left")
    ld, lr, hd, hr = F.col("_lo_days"), F.col("_lo_rate"), F.col("_hi_days"), F.col("_hi_rate")
    val = (F.when(ld.isNull(), hr)
            .when(hd.isNull(), lr)
            .otherwise(lr + (hr - lr) * (t - ld) / (hd - ld)))
    return j.withColumn(out, val).drop("_d", "_lo_days", "_lo_rate", "_hi_days", "_hi_rate")


def greeks(df: DataFrame, forward: str = "forward_price", strike: str = "strike", years: str = "t",
           vol: str = "impl_volatility", rate: str = "r", cp: str = "cp_flag") -> DataFrame:
    """Black-76 delta, gamma, vega, theta (per year) from IV; NULL without IV.

    ``rate`` is a continuously compounded decimal rate; ``years`` the time to
    expiry in years.
    """
    Fw, K, T, s, r = F.col(forward), F.col(strike), F.col(years), F.col(vol), F.col(rate)
    ok = s.isNotNull() & (s > 0) & (T > 0) & (Fw > 0) & (K > 0)
    # staged so each sub-result is evaluated once (one flat expression tree is
    # too large for generated code to stay fast)
    srt = s * F.sqrt(T)
    d1 = (F.log(Fw / K) + F.lit(0.5) * s * s * T) / srt
    out = df.withColumns({"_ok": ok, "_d1": d1, "_disc": F.exp(-r * T), "_sqt": F.sqrt(T)})
    out = out.withColumn("_d2", F.col("_d1") - F.col(vol) * F.col("_sqt"))
    # two CDFs, each in steps whose parts are columns of their own; N(-x) = 1 - N(x)
    out = out.withColumns({"_t1": cdf_t(F.col("_d1")), "_t2": cdf_t(F.col("_d2")), "_p1": norm_pdf(F.col("_d1")),
                           "_p2": norm_pdf(F.col("_d2"))})
    out = out.withColumns({"_u1": cdf_tail(F.col("_t1"), F.col("_p1")), "_u2": cdf_tail(F.col("_t2"), F.col("_p2"))})
    out = out.withColumns({f"_n{i}": F.when(F.col(f"_d{i}") >= 0, F.lit(1.0) - F.col(f"_u{i}")).otherwise(F.col(f"_u{i}")) for i in (1, 2)})
    disc, n1, n2, p1 = (F.col(c) for c in ("_disc", "_n1", "_n2", "_p1"))
    n1m, n2m = F.lit(1.0) - n1, F.lit(1.0) - n2
    call = F.col(cp) == "C"
    delta = F.when(call, disc * n1).otherwise(disc * (n1 - F.lit(1.0)))
    gamma = disc * p1 / (Fw * (s * F.col("_sqt")))
    vega = Fw * disc * p1 * F.col("_sqt")
    decay = -Fw * disc * p1 * s / (F.lit(2.0) * F.col("_sqt"))
    theta = F.when(call, decay + r * Fw * disc * n1 - r * K * disc * n2) \
        .otherwise(decay - r * Fw * disc * n1m + r * K * disc * n2m)
    ok = F.col("_ok")
    out = out.withColumns({"bs_delta": F.when(ok, delta), "bs_gamma": F.when(ok, gamma),
                           "bs_vega": F.when(ok, vega), "bs_theta": F.when(ok, theta)})
    return out.drop("_ok", "_d1", "_d2", "_disc", "_sqt", "_n1", "_n2", "_p1", "_p2", "_t1", "_t2", "_u1", "_u2")


def greeks_qc(df: DataFrame, stored: dict[str, str] | None = None, tol: float = 0.05) -> DataFrame:
    """F21 QC: recomputed vs stored Greeks — absolute difference and a within-``tol`` flag each."""
    stored = stored or {"bs_delta": "delta", "bs_gamma": "gamma", "bs_vega": "vega", "bs_theta": "theta"}
    out = df
    for mine, theirs in stored.items():
        d = F.abs(F.col(mine) - F.col(theirs))
        out = out.withColumns({f"{theirs}_absdiff": d, f"{theirs}_ok": d <= F.lit(tol)})
    return out
