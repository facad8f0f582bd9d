"""Ordered scans per key: running values that no single task has to compute alone.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task; a
key holding a third of all rows would then be sorted by a single executor.
Where the input may be large the scans here partition by ``(key, bucket)``
instead, the bucket a non-decreasing function of the order columns:

1. rows are shuffled once, by (key, bucket);
2. inside each (key, bucket): a window scan over the rows;
3. per (key, bucket): one summary value, aggregated from the same shuffled rows
   (the exchange is reused, the input is not read again for it);
4. per key over the summaries, a small table, a window scan gives what earlier
   (or later) buckets carry in, which is joined back and combined.

By default only keys with a large share of the rows, of which a sample holds many, have more
than one bucket: ranges of the order columns between cut points from the sample, so a
burst at one time is cut as well, by the tie-break columns if need be.  All other keys are
scanned whole in the shuffled rows, and steps 3 and 4 see the few large keys alone.
The sample is drawn by a hash of the rows, so the cut points are a function of the data
alone: any re-run of a task sees the same buckets.  Nothing runs while a query is built: the
large keys and their cut points are a small table that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bucket(grain: str = "month"):
    """Bucket function for date/timestamp order columns: ``date_trunc(grain, t)``.

    Pick the grain so one (key, bucket) fits a task: a key holding a third of
    100 TB over 25 years is ~100 GB per month, ~4 GB per day, ~150 MB per hour.
    Finer grains make the summary table longer (one row per non-empty
    (key, bucket)), never the data shuffle.
    """
    def bucket(c: str | Column) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return F.date_trunc(grain, c).cast("timestamp_ntz" if grain in ("hour", "minute") else "date")
    return bucket


month_bucket = time_bucket("month")

# fixed values: candidate grains from coarse to fine
_GRAINS = ("month", "day", "hour", "minute")


def auto_grain(df: DataFrame, key: Sequence[str], time: str, target_rows: int = 2_000_000) -> str:
    """The coarsest grain whose buckets hold at most ``target_rows`` rows of the hottest key.

    One small aggregate tells whether any key has more rows than that at all; if
    none has, months do.  Otherwise the rows of those keys only are counted per
    finest slot, the counts are summed up to each grain, and the fullest
    bucket of each grain comes back as one row; so a burst inside a long span
    counts as the burst it is.
    """
    finest = "day" if df.schema[time].dataType.simpleString() == "date" else "minute"
    grains = [g for g in _GRAINS if finest == "minute" or g in ("month", "day")]
    rows = df.select(F.struct(*key).alias("_k"), F.col(time).cast("timestamp_ntz").alias("_t"))
    hot = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows).select("_k")
    if hot.first() is None:
        return grains[0]
    slots = rows.join(hot, "_k", "left_semi").groupBy("_k", F.date_trunc(finest, "_t").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    fullest = None
    for grain in grains:
        top = slots.groupBy("_k", F.date_trunc(grain, "_t").alias("_b")).agg(F.sum("_n").alias("_n")) \
            .agg(F.max("_n").alias("_n")).select(F.lit(grain).alias("grain"), "_n")
        fullest = top if fullest is None else fullest.unionByName(top)
    most = {r["grain"]: r["_n"] or 0 for r in fullest.collect()}      # one row for each grain
    return next((g for g in grains if most[g] <= target_rows), grains[-1])


def _within_agg(op: str, v: Column, w) -> Column:
    if op == "last":
        return F.last(v, ignorenulls=True).over(w)
    if op == "first":
        return F.first(v, ignorenulls=True).over(w)
    return _AGGREGATES[op](v).over(w)


_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "product": F.product}


def _combine(op: str, within: Column, carry: Column) -> Column:
    if op in ("last", "first"):
        return F.coalesce(within, carry)
    if op in ("sum", "count"):
        return F.when(within.isNull() & carry.isNull(), F.lit(None)) \
            .otherwise(F.coalesce(within, F.lit(0)) + F.coalesce(carry, F.lit(0)))
    if op == "product":
        return F.when(within.isNull() & carry.isNull(), F.lit(None)) \
            .otherwise(F.coalesce(within, F.lit(1.0)) * F.coalesce(carry, F.lit(1.0)))
    if op == "max":
        return F.greatest(within, carry)   # greatest/least skip NULLs
    if op == "min":
        return F.least(within, carry)
    raise ValueError(op)


#: Input files of this many bytes in all are scanned key by key, without buckets: one task can sort (and spill) them.
SMALL_BYTES = 64 << 20
#: Most cut points, and sampled rows for each.
MAX_CUTS, SAMPLED = 16_384, 16
#: Most cut points of large keys; their sample is sorted by one task.
MAX_KEY_CUTS = 4096


def input_bytes(df: DataFrame) -> int:
    """Bytes of all tables that ``df`` reads, as the optimizer knows them (file sizes; nothing is run).

    Frames made from local data or RDDs have no known size and count as very large.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _range_bucket(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_bk``: how many cut points of ``cols`` lie at or before the row.

    Rows whose hash falls below a share of the hash range, set by the row count, are
    the sample (about ``SAMPLED`` rows a cut); every SAMPLED-th of them in order is a cut.
    """
    cuts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_CUTS)
    point = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    sample = df.select(point.alias("_range_point")).where(
        F.pmod(F.xxhash64("_range_point"), F.lit(1 << 40)) <= F.lit(float(cuts * SAMPLED * (1 << 40))) / F.greatest(rows, F.lit(1)))
    points = sample.agg(F.sort_array(F.collect_list("_range_point")).alias("_points")) \
        .select(F.filter("_points", lambda _, i: i % SAMPLED == SAMPLED - 1).alias("_range_cuts")).scalar()
    d = df.withColumns({"_range_cuts": points, "_range_point": point})
    # binary search: from the greatest power of two down, step over cuts that are not behind the row
    powers = F.array(*[F.lit(1 << i) for i in range((2 * cuts).bit_length(), -1, -1)])
    found = F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get("_range_cuts", at + p - 1) <= F.col("_range_point"), at + p).otherwise(at))
    return d.withColumn("_bk", found).drop("_range_cuts", "_range_point")


def _large_key_bucket(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_bk``: how many cut points of the row's own key lie at or before it, and ``_large``: whether it has any.

    The rows of smallest hash are the sample, about ``SAMPLED`` a cut; a key with as many among them is large, and
    every SAMPLED-th of its points in order is a cut.
    """
    cuts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_KEY_CUTS)
    own = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])
    point = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
    sample = df.select(own.alias("_large_key"), point.alias("_large_point")).orderBy(F.xxhash64("_large_key", "_large_point")).limit(cuts * SAMPLED)
    points = sample.groupBy("_large_key").agg(F.sort_array(F.collect_list("_large_point")).alias("_points")).where(F.size("_points") >= SAMPLED)
    large = points.select("_large_key", F.filter("_points", lambda _, i: i % SAMPLED == SAMPLED - 1).alias("_large_cuts"))
    d = df.withColumns({"_own_key": own, "_own_point": point})
    d = d.join(F.broadcast(large), F.col("_own_key") == F.col("_large_key"), "left")           # one key a cut at most
    powers = F.array(*[F.lit(1 << i) for i in range((2 * cuts).bit_length(), -1, -1)])
    found = F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get("_large_cuts", at + p - 1) <= F.col("_own_point"), at + p).otherwise(at))
    return d.withColumn("_bk", F.when(F.col("_large_cuts").isNull(), 0).otherwise(found)).withColumn("_large", F.col("_large_cuts").isNotNull()) \
        .drop("_large_key", "_large_cuts", "_own_key", "_own_point")


def ordered_scans(df: DataFrame, key: Sequence[str], order: Sequence[str],
                  aggs: Sequence[tuple[Column | str, str, str]], inclusive: bool = True,
                  descending: bool = False, bucket: Column | str | None = "auto") -> DataFrame:
    """Several running values over the same key and order in one pass.

    ``aggs`` = [(value, op, out), ...].  One exchange serves all of them.
    ``order`` must be a total order inside a key (end it with a tie-break).
    ``op``: ``last`` (newest non-NULL value), ``first``, ``sum``, ``count``,
    ``max``, ``min``, ``product`` (of doubles; a zero stays zero, NULLs are skipped).
    ``inclusive`` includes the row itself.  ``descending``
    scans from the end (so ``last`` becomes "the next non-NULL value").
    ``bucket``: ``"auto"`` (default) cuts large keys by a sample (``"large"``), or
    scans key by key where all inputs together are at most ``SMALL_BYTES`` (``"key"``);
    ``"range"`` cuts ranges of (key, order); a grain name (``"day"``), ``None`` (months) or an own
    non-decreasing function of ``order[0]`` cuts by time.
    """
    key = list(key)
    if isinstance(bucket, str) and bucket == "auto":
        bucket = "key" if input_bytes(df) <= SMALL_BYTES else "large"
    vals = {f"_v{i}": (F.col(v) if isinstance(v, str) else v) for i, (v, _, _) in enumerate(aggs)}
    columns = list(df.columns)
    if isinstance(bucket, str) and bucket == "key":
        b = F.lit(0)
    elif isinstance(bucket, str) and bucket == "range":
        df = _range_bucket(df, [*key, *order])
        b = F.col("_bk")
    elif isinstance(bucket, str) and bucket == "large":
        df = _large_key_bucket(df, key, order)
        b = F.col("_bk")
    elif isinstance(bucket, str):
        b = time_bucket(bucket)(order[0])
    else:
        b = bucket if bucket is not None else month_bucket(order[0])
    # key and bucket in one struct: it is never NULL, and NULL parts are equal to each other in
    # groups, windows and the join alike
    d = df.withColumn("_kb", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], b.alias("bk"))).withColumns(vals)
    few = isinstance(bucket, str) and bucket == "large"
    d = d.select(*columns, "_kb", *vals, *(["_bk", "_large"] if few else []))
    whole = isinstance(bucket, str) and bucket in ("key", "large")
    # plain columns sort faster than a struct, numbers before text; without buckets of all keys nothing else needs the struct
    types = dict(df.dtypes)
    near = sorted(key, key=lambda c: types.get(c) == "string") + (["_bk"] if few else []) if whole else ["_kb"]
    sort = [F.col(o).desc_nulls_last() if descending else F.col(o).asc_nulls_first() for o in order]
    frame_end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy(*near).orderBy(*sort).rowsBetween(Window.unboundedPreceding, frame_end)
    within = {f"_w{i}": _within_agg(op, F.col(f"_v{i}"), w_in) for i, (_, op, _) in enumerate(aggs)}
    if isinstance(bucket, str) and bucket == "key":
        return d.withColumns(within).withColumns({out: F.col(f"_w{i}") for i, (_, _, out) in enumerate(aggs)}).drop("_kb", *vals, *within)
    d = d.repartition(*near)
    rows = d.withColumns(within).drop("_bk", "_large")

    # one summary row per (key, bucket): what the whole bucket passes on
    order_struct = F.struct(*[F.col(o) for o in order])
    totals = []
    for i, (_, op, _) in enumerate(aggs):
        v = F.col(f"_v{i}")
        if op in ("last", "first"):
            pick_last = (op == "last") != descending
            ordv = F.when(v.isNotNull(), order_struct)
            totals.append((F.max_by if pick_last else F.min_by)(v, ordv).alias(f"_t{i}"))
        else:
            totals.append(_AGGREGATES[op](v).alias(f"_t{i}"))
    # any one row of the bucket, whole: rows and summary then need the same columns of the same exchange, which is reused
    if few:
        # a predicate that is not deterministic stays behind the exchange, so it is still the one that the rows come from
        d = d.where(F.when(F.col("_large"), F.rand(0) >= 0).otherwise(F.lit(False)))
    summary = d.groupBy("_kb").agg(*totals, F.first(F.struct(*columns)).alias("_one"))
    bsort = F.col("_kb.bk").desc_nulls_last() if descending else F.col("_kb.bk").asc_nulls_first()
    w_c = Window.partitionBy(*[F.col(f"_kb.k{i}") for i in range(len(key))]).orderBy(bsort).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select("_kb", *[
        F.when(F.col("_one").isNotNull(), _within_agg("sum" if op == "count" else op, F.col(f"_t{i}"), w_c)).alias(f"_c{i}")
        for i, (_, op, _) in enumerate(aggs)])

    res = rows.join(F.broadcast(summary) if few else summary, "_kb", "left")          # a row for each cut of the few large keys
    res = res.withColumns({out: _combine(op, F.col(f"_w{i}"), F.col(f"_c{i}"))
                           for i, (_, op, out) in enumerate(aggs)})
    tmp = ["_kb"] + [f"_{p}{i}" for i in range(len(aggs)) for p in ("v", "w", "c")]
    return res.drop(*tmp)


def ordered_scan(df: DataFrame, key: Sequence[str], order: Sequence[str], value: Column | str, op: str,
                 out: str, inclusive: bool = True, descending: bool = False,
                 bucket: Column | str | None = "auto") -> DataFrame:
    """Add ``out`` = ``op`` of ``value`` over the rows of the same key before each row.

    A single-value :func:`ordered_scans`; see there for the arguments.
    """
    return ordered_scans(df, key, order, [(value, op, out)], inclusive, descending, bucket)
