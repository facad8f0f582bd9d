"""Point-in-time operators: as-of join, stops, restatements, estimate panel, consensus.

PySpark has no public as-of join.  Here both sides are unioned into one
stream per key, ordered by time, and the newest right-side payload is
carried forward to each left row with :func:`ordered_scan` (split by time
bucket, so a hot key is not one task).  No inequality join and no fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.operators.intervals import exclude_days
from quantlake.operators.quality import keep_one
from quantlake.operators.quantiles import exact_median
from quantlake.operators.scan import ordered_scan


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              right_cols: Sequence[str] | None = None, strict: bool = False, direction: str = "backward",
              tie_break: Sequence[str] = (), prefix: str = "", bucket="auto",
              missing_date: str | None = "1970-01-01") -> DataFrame:
    """Each left row + the right row of the same key nearest in time.

    ``backward``: newest right row with ``right_time <= left_time`` (``<``
    when ``strict``).  ``forward``: earliest right row with ``right_time >=
    left_time`` (``>`` when strict).  Right rows at the same time are ordered
    by ``tie_break`` (the last one wins backward, the first forward).  Left
    rows without a match keep NULLs (a left as-of join).  ``bucket`` is a
    bucket function or one of the names :func:`ordered_scans` knows.

    As in SQL, NULL keys match nothing, and a NULL time on either side
    matches nothing; neither does a date equal to ``missing_date`` on either side (the zero
    date that stands for "unknown"; None keeps it).  Such right rows are
    dropped, such left rows skip the scan and keep NULLs, so they never form
    a hot group.
    """
    on = list(on)
    usable = F.lit(True)
    for c in on:
        usable = usable & F.col(c).isNotNull()

    def known(df: DataFrame, time: str) -> Column:
        dated = df.schema[time].dataType.simpleString()
        if missing_date and (dated == "date" or dated.startswith("timestamp")):
            return F.col(time).isNotNull() & (F.col(time).cast("date") != F.lit(missing_date).cast("date"))
        return F.col(time).isNotNull()

    right = right.where(usable & known(right, right_time))
    matchable = usable & known(left, left_time)
    aside = left.where(~matchable)
    left = left.where(matchable)
    right_cols = list(right_cols or [c for c in right.columns if c not in on])
    lcols = [c for c in left.columns if c not in on]
    payload = F.struct(*[F.col(c).alias(c) for c in right_cols])
    lrow = F.struct(*[F.col(c).alias(c) for c in lcols])
    tb = F.struct(*[F.col(c).alias(c) for c in tie_break]) if tie_break else F.lit(0)

    def dtype(df, col):
        return df.select(col.alias("x")).schema["x"].dataType

    ptype, ltype, tbtype = dtype(right, payload), dtype(left, lrow), dtype(right, tb)
    lt, rt = left.schema[left_time].dataType.simpleString(), right.schema[right_time].dataType.simpleString()
    # order both sides on a common type; a date meets a timestamp as its midnight, as in SQL
    ttype = "timestamp_ntz" if lt != rt and "date" in (lt, rt) and "timestamp" in lt + rt else lt
    # side order at equal time: the side that must be seen first gets 0
    r_side, l_side = (0, 1) if not strict else (1, 0)
    if direction == "forward":
        r_side, l_side = l_side, r_side
    L = left.select(*on, F.col(left_time).cast(ttype).alias("_t"), F.lit(l_side).alias("_s"),
                    F.lit(None).cast(tbtype).alias("_tb"), lrow.alias("_l"), F.lit(None).cast(ptype).alias("_p"))
    R = right.select(*on, F.col(right_time).cast(ttype).alias("_t"), F.lit(r_side).alias("_s"),
                     tb.alias("_tb"), F.lit(None).cast(ltype).alias("_l"), payload.alias("_p"))
    u = L.unionByName(R)
    if callable(bucket):
        bucket = bucket(F.col("_t"))
    scanned = ordered_scan(u, on, ["_t", "_s", "_tb"], "_p", "last", "_m", inclusive=True,
                           descending=(direction == "forward"), bucket=bucket)
    out = scanned.where(F.col("_l").isNotNull())
    found = out.select(*on, *[F.col(f"_l.{c}").alias(c) for c in lcols],
                       *[F.col(f"_m.{c}").alias(prefix + c) for c in right_cols])
    nothing = F.lit(None).cast(ptype)
    return found.unionByName(aside.select(*on, *lcols, *[nothing[c].alias(prefix + c) for c in right_cols]))


def apply_stops(est: DataFrame, stops: DataFrame, on: Sequence[str], active_from: str, stop_at: str,
                out: str = "valid_to", strict: bool = False) -> DataFrame:
    """Each estimate gets the first stop at or after its activation.

    A forward as-of join on the key; ``valid_to`` is NULL while no stop follows.
    """
    s = stops.select(*on, F.col(stop_at).alias(out))
    return asof_join(est, s, on, active_from, out, [out], strict=strict, direction="forward")


def latest_restatement(df: DataFrame, key: Sequence[str], as_of: str, stamp_cols: Sequence[str],
                       time_col: str | None = None) -> DataFrame:
    """The newest row per key with its stamp at or before ``as_of``.

    ``row_number() = 1`` keeps one row a key before the shuffle already
    (a window group limit), so a key with many restatements is reduced on
    the map side.  A timestamp on the last day counts as that day.
    """
    t = time_col or stamp_cols[0]
    known = df.where(F.col(t).cast("date") <= F.lit(as_of).cast("date"))
    return keep_one(known, key, [F.col(c).desc_nulls_last() for c in stamp_cols])


def valid_to_next(df: DataFrame, key: Sequence[str], start: str, tie_break: Sequence[str] = (),
                  out: str = "valid_to", minus_days: int = 1) -> DataFrame:
    """Interval end = next record's start − 1 day (NULL for the last record).

    The "next start" is a descending ``ordered_scan`` (strict), not a
    ``lead`` over a window per key.
    """
    order = [start, *tie_break]
    nxt = ordered_scan(df, key, order, F.col(start), "last", "_next", inclusive=False, descending=True)
    return nxt.withColumn(out, F.date_sub(F.col("_next").cast("date"), minus_days)).drop("_next")


_MONTHS = {"month": 1, "quarter": 3}


def first_observation(valid_from: Column, grain: str = "quarter") -> Column:
    """The first period start (month or quarter) at or after ``valid_from``."""
    first = F.date_trunc(grain, valid_from).cast("date")
    return F.when(first < valid_from.cast("date"), F.add_months(first, _MONTHS[grain])).otherwise(first)


def later_observations(first: Column, valid_to: Column, grain: str = "quarter") -> Column:
    """How many period starts after ``first``, itself one, lie at or before ``valid_to``."""
    months = (F.year(valid_to) - F.year(first)) * 12 + F.month(valid_to) - F.month(first)
    return F.floor(months / _MONTHS[grain]).cast("int")


def estimate_panel(est: DataFrame, key: Sequence[str], estimator: str, time: str, value: str,
                   end: str, grain: str = "quarter", stops: DataFrame | None = None,
                   stop_at: str | None = None, excluded: DataFrame | None = None,
                   exc_start: str | None = None, exc_end: str | None = None,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per (key, estimator, observation date) with the live estimate.

    An estimate is live from its ``time`` until the next estimate of the same
    (key, estimator) (W6), or its stop (J17), or ``end``.  Each estimate is
    expanded to the period starts it covers with an exploded sequence —
    a generator, no cross join.  Observation dates inside an exclusion window
    of that (key, estimator) are left out before (J16).
    """
    k = list(key) + [estimator]
    e = valid_to_next(est, k, time, tie_break, out="_vt")
    vt = F.coalesce(F.col("_vt"), F.lit(end).cast("date"))
    if stops is not None:
        e = apply_stops(e, stops, k, time, stop_at, out="_stop")
        vt = F.least(vt, F.date_sub(F.col("_stop").cast("date"), 1))
    e = e.withColumn("_vt2", F.least(vt, F.lit(end).cast("date")))
    e = e.select(*k, F.col(value).alias("value"), F.col(time).cast("date").alias("active_from"), "_vt2",
                 first_observation(F.col(time).cast("date"), grain).alias("_first")).where(F.col("_first") <= F.col("_vt2"))
    later = F.sequence(F.lit(0), later_observations(F.col("_first"), F.col("_vt2"), grain))
    day = lambda i: F.add_months("_first", i * _MONTHS[grain])
    if excluded is None:
        # the estimates with their ends are moved once more, and every aggregate of the panel reads them there
        e = e.repartition(*k, "active_from")
        return e.select(*k, "value", "active_from", "_first", F.explode(later).alias("_i")).select(*k, "value", "active_from", day(F.col("_i")).alias("obs_date"))
    # a window without an end excludes nothing here
    e = e.select(*k, "value", "active_from", F.transform(later, day).alias("_days"))
    return exclude_days(e, "_days", "obs_date", excluded.where(F.col(exc_end).isNotNull()), k, exc_start, exc_end)


def consensus(panel: DataFrame, by: Sequence[str], value: str = "value", digits: int = 6) -> DataFrame:
    """Count / mean / median / stdev / high / low of live estimates per group."""
    by = list(by)
    stats = panel.groupBy(*by).agg(F.count(value).alias("n_est"), F.round(F.avg(value), digits).alias("mean_est"),
                                   F.round(F.stddev_samp(value), digits).alias("std_est"),
                                   F.max(value).alias("high_est"), F.min(value).alias("low_est"))
    med = exact_median(panel, value, by, "_med")
    # groups meet as one struct, so a NULL group keeps its median
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)])
    return (stats.withColumn("_g", group).join(med.select(group.alias("_g"), "_med"), "_g", "left")
            .withColumn("median_est", F.round("_med", digits)).drop("_g", "_med"))


def surprise(actuals: DataFrame, cons: DataFrame, on: Sequence[str], actual_col: str = "actual",
             expected_col: str = "mean_est") -> DataFrame:
    """Actual − consensus, and relative surprise, joined on the period key."""
    j = actuals.join(cons, list(on), "inner")
    return j.withColumn("surprise", F.col(actual_col) - F.col(expected_col)) \
        .withColumn("surprise_pct", F.try_divide(F.col("surprise"), F.abs(F.col(expected_col))))
