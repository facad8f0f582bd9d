"""Data-quality jobs over a landed table (staging or main).

All checks are plain aggregations: Spark runs them as partial (map-side)
plus final aggregates, so a key that holds a third of all rows is reduced
inside each map task before anything is shuffled.  Several checks can be
fused into one scan with :func:`staging_qc`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantlake.functions import scalars as S
from quantlake.operators.scan import input_bytes


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _agg(df: DataFrame, by, exprs: Sequence[Column]) -> DataFrame:
    by = _by(by)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def _label(df: DataFrame, check: str | None, by) -> DataFrame:
    if not check:
        return df
    cols = [F.lit(check).alias("check")] + [F.col(c) for c in df.columns]
    return df.select(*cols)


# --- D1 ---------------------------------------------------------------------
def row_count_exprs(date_cols: Sequence[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    for c in date_cols:
        out += [F.min(c).alias(f"min_{c.lower()}"), F.max(c).alias(f"max_{c.lower()}")]
    return out


def row_count_and_range(df: DataFrame, date_cols: Sequence[str], by=None,
                        check: str | None = "row_count_and_range") -> DataFrame:
    """Row count plus min/max of each date column."""
    return _label(_agg(df, by, row_count_exprs(date_cols)), check, by)


# --- D2 ---------------------------------------------------------------------
def fraction(pred: Column, digits: int = 4) -> Column:
    """``round(countIf(pred) / count(), 4)``; empty input → NULL, not an error."""
    return F.round(F.try_divide(F.count_if(pred).cast("double"), F.count(F.lit(1)).cast("double")), digits)


def null_profile_exprs(rules: Mapping[str, Column], digits: int = 4) -> list[Column]:
    return [fraction(pred, digits).alias(name) for name, pred in rules.items()]


def null_profile(df: DataFrame, rules: Mapping[str, Column], by=None, digits: int = 4,
                 check: str | None = "null_profile") -> DataFrame:
    """Fractions of rows matching each named predicate (NULL, zero date, placeholder)."""
    return _label(_agg(df, by, null_profile_exprs(rules, digits)), check, by)


def default_null_rules(value: str, zero_dates: Sequence[str] = (), codes: Sequence[str] = ()) -> dict:
    """The reference's rule set: NULL value, zero dates, missing codes."""
    rules = {f"pct_{value.lower()}_null": F.col(value).isNull()}
    for d in zero_dates:
        rules[f"pct_{d.lower()}_zero"] = S.is_zero_date(d)
    for c in codes:
        rules[f"pct_{c.lower()}_missing"] = S.is_missing_code(c)
    return rules


# --- D3 ---------------------------------------------------------------------
def value_extreme_exprs(col: str, sentinel: float = S.VALUE_SENTINEL,
                        limit: float = S.VALUE_LIMIT) -> list[Column]:
    c = F.col(col)
    return [F.min(c).alias("minv"), F.max(c).alias("maxv"),
            F.count_if(c == F.lit(sentinel)).alias("n_neg99999"),
            F.count_if(F.abs(c) > F.lit(limit)).alias("n_extreme")]


def value_extremes(df: DataFrame, col: str, sentinel: float = S.VALUE_SENTINEL,
                   limit: float = S.VALUE_LIMIT, by=None, check: str | None = "value_extremes") -> DataFrame:
    """min, max, sentinel count and count above the suspect limit."""
    return _label(_agg(df, by, value_extreme_exprs(col, sentinel, limit)), check, by)


# --- D4 ---------------------------------------------------------------------
def distinct_exprs(cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> list[Column]:
    if approx:
        return [F.approx_count_distinct(c, rsd).alias(f"n_{c.lower()}") for c in cols]
    return [F.count_distinct(F.col(c)).alias(f"n_{c.lower()}") for c in cols]


def distinct_codes(df: DataFrame, cols: Sequence[str], by=None, approx: bool = False,
                   check: str | None = "distinct_codes") -> DataFrame:
    """Exact (default) or approximate distinct count per column; NULL not counted."""
    return _label(_agg(df, by, distinct_exprs(cols, approx)), check, by)


# --- D5 ---------------------------------------------------------------------
def duplicates(df: DataFrame, key: Sequence[str], by=None, check: str | None = "duplicates") -> DataFrame:
    """``dup_rows = count - distinct(key tuple)``; tuples with NULL parts count.

    Computed as a grouped count on the key (partial aggregation collapses a
    hot key on the map side) instead of a distinct over a wide struct.
    """
    by = _by(by)
    per_key = df.groupBy(*(by + list(key))).agg(F.count(F.lit(1)).alias("_n"))
    exprs = [(F.sum("_n") - F.count(F.lit(1))).cast("long").alias("dup_rows"),
             F.sum("_n").cast("long").alias("total_rows")]
    out = per_key.groupBy(*by).agg(*exprs) if by else per_key.agg(*exprs)
    if not by:  # empty input still yields one row of zeros
        out = out.select(F.coalesce("dup_rows", F.lit(0)).cast("long").alias("dup_rows"),
                         F.coalesce("total_rows", F.lit(0)).cast("long").alias("total_rows"))
    return _label(out, check, by)


#: Input files beyond this many bytes are dealt out by key, in parts of ``KEY_PART`` bytes (some 200,000 narrow rows).
KEYS_APART, KEY_PART = 16 << 20, 4 << 20


# --- fused D1-D5 -------------------------------------------------------------
def staging_qc(df: DataFrame, date_cols: Sequence[str], null_rules: Mapping[str, Column],
               value_col: str, code_cols: Sequence[str], key: Sequence[str], by=None,
               approx: bool = False) -> DataFrame:
    """D1–D5 in one pass over the staged chunk (one wide row per group).

    Exact distincts of several columns in one aggregate would multiply every row
    (``Expand``).  Instead rows are grouped by the key, and the groups by the codes, each with
    partial counts that add up; only the combinations of codes, few against the
    rows, are looked at once for every code.  Codes outside the key are combined on their
    own, from those columns alone.  ``approx`` uses sketches in one aggregate.
    """
    by = _by(by)
    if approx:
        exprs = (row_count_exprs(date_cols) + null_profile_exprs(null_rules)
                 + value_extreme_exprs(value_col) + distinct_exprs(code_cols, True))
        dup = (F.count(F.lit(1)) - F.approx_count_distinct(F.struct(*[F.col(k) for k in key]))).cast("long").alias("dup_rows")
        return _agg(df, by, exprs + [dup])
    key, codes = list(key), list(code_cols)
    named = {f"_by{i}": F.col(c) for i, c in enumerate(by)} | {f"_key{i}": F.col(c) for i, c in enumerate(key)}
    outside = [c for c in codes if c not in key]
    v = F.col(value_col)
    # figure: (value of a row, how partial figures add up)
    figures = {"rows": (F.lit(1), F.sum)}
    for c in date_cols:
        figures |= {f"min_{c.lower()}": (F.col(c), F.min), f"max_{c.lower()}": (F.col(c), F.max)}
    figures |= {name: (F.when(rule, 1).otherwise(0), F.sum) for name, rule in null_rules.items()}
    figures |= {"minv": (v, F.min), "maxv": (v, F.max), "n_neg99999": (F.when(v == F.lit(S.VALUE_SENTINEL), 1).otherwise(0), F.sum),
                "n_extreme": (F.when(F.abs(v) > F.lit(S.VALUE_LIMIT), 1).otherwise(0), F.sum)}
    figure_cols = {f"_f{i}": name for i, name in enumerate(figures)}
    add = [how(f).alias(f) for f, (_, how) in zip(figure_cols, figures.values())]
    # most keys are different, so the table of a task's keys grows with its rows: a larger input is dealt out
    # by key first, in as many parts as it needs (a size that is not known leaves the number to the session)
    size = input_bytes(df)
    dealt = df.repartition(-(-size // KEY_PART), *by, *key) if KEYS_APART < size < 1 << 60 else df
    rows = dealt.select(*[c.alias(n) for n, c in named.items()], *[x.alias(f) for f, (x, _) in zip(figure_cols, figures.values())])
    keys = rows.groupBy(*named).agg(*add)
    bys = [f"_by{i}" for i in range(len(by))]
    values = {f"_v{i}": c for i, c in enumerate(codes)}
    combos = keys.groupBy(*bys, *dict.fromkeys(f"_key{key.index(c)}" for c in codes if c in key)).agg(*add, F.count(F.lit(1)).alias("_keys"))
    carried = [*figure_cols, "_keys"]

    def entry(which: int, value: dict) -> Column:
        """A row of figures (which = -1), or one of a code's values."""
        cols = [F.lit(which).alias("code"), *[(value[n] if n in value else F.lit(None)).cast(df.schema[c].dataType).alias(n) for n, c in values.items()]]
        return F.struct(*cols, *[(F.col(f) if which < 0 else F.lit(None)).cast(combos.schema[f].dataType).alias(f) for f in carried])

    within = [entry(-1, {}), *[entry(i, {n: F.col(f"_key{key.index(c)}")}) for i, (n, c) in enumerate(values.items()) if c in key]]
    long = combos.select(*bys, F.explode(F.array(*within)).alias("_e")).select(*bys, "_e.*")
    if outside:
        apart = df.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"_out{i}") for i, c in enumerate(outside)]).distinct()
        others = [entry(i, {n: F.col(f"_out{outside.index(c)}")}) for i, (n, c) in enumerate(values.items()) if c in outside]
        long = long.unionByName(apart.select(*bys, F.explode(F.array(*others)).alias("_e")).select(*bys, "_e.*"))
    once = long.groupBy(*bys, "code", *values).agg(*add, F.sum("_keys").alias("_keys"))
    total = F.sum("_f0")
    # a share is the sum of its rows over all rows; no rows: NULL, and counts are 0
    exprs = []
    for f, name in figure_cols.items():
        how = figures[name][1]
        if name in null_rules:
            exprs.append(F.round(F.try_divide(F.sum(f).cast("double"), total.cast("double")), 4).alias(name))
        elif how is F.sum:
            exprs.append(F.coalesce(F.sum(f), F.lit(0)).cast("long").alias(name))
        else:
            exprs.append(how(f).alias(name))
    exprs += [F.count_if((F.col("code") == i) & F.col(n).isNotNull()).alias(f"n_{c.lower()}") for i, (n, c) in enumerate(values.items())]
    exprs.append(F.coalesce(total - F.sum("_keys"), F.lit(0)).cast("long").alias("dup_rows"))
    out = once.groupBy(*bys).agg(*exprs) if by else once.agg(*exprs)
    return out.withColumnsRenamed({f"_by{i}": c for i, c in enumerate(by)})


def _as_number(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.simpleString()
    if t == "date":
        return F.unix_date(F.col(c)).cast("double")          # days since 1970-01-01
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double") / 1e6
    return F.col(c).cast("double")


def tidy(wide: DataFrame, check: str, by=None) -> DataFrame:
    """Wide one-row-per-group check output → rows ``(check, metric, value)``.

    Values are doubles; dates become days since 1970-01-01 so limits can be
    set on them too.
    """
    by = _by(by)
    metrics = [c for c in wide.columns if c not in by and c != "check"]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), _as_number(wide, m).alias("value")) for m in metrics]))
    return wide.select(*by, F.lit(check).alias("check"), stacked.alias("_m")) \
        .select(*by, "check", "_m.metric", "_m.value")


# --- D8 ---------------------------------------------------------------------
_OPS = {"<=": lambda v, l: v <= l, "<": lambda v, l: v < l, ">=": lambda v, l: v >= l,
        ">": lambda v, l: v > l, "==": lambda v, l: v == l}


def gate(checks: DataFrame, thresholds: Mapping[tuple[str, str], tuple[str, float]]) -> DataFrame:
    """Attach limits to tidy checks and decide pass/fail per metric.

    ``thresholds`` maps ``(check, metric)`` → ``(op, limit)``.  The limit table
    is built from that user-given mapping, so its size is bounded by it and it
    is broadcast.  A metric without a limit passes; a NULL value fails.
    """
    spark = checks.sparkSession
    rows = [(c, m, op, float(lim)) for (c, m), (op, lim) in thresholds.items()]
    lim = spark.createDataFrame(rows, "check string, metric string, op string, limit double")
    j = checks.join(F.broadcast(lim), ["check", "metric"], "left")
    v, l, op = F.col("value"), F.col("limit"), F.col("op")
    passed = F.when(op.isNull(), F.lit(True))
    for name, fn in _OPS.items():
        passed = passed.when(op == name, F.coalesce(fn(v, l), F.lit(False)))
    return j.select("check", "metric", "value", "limit", "op", passed.otherwise(F.lit(False)).alias("passed"))


# --- D9, A16-A18, A20, A21 ------------------------------------------------------
def period_col(date_col: str, grain: str = "year") -> Column:
    d = F.col(date_col)
    if grain == "year":
        return F.year(d).cast("int")
    if grain == "month":
        return F.date_trunc("month", d).cast("date")
    if grain == "day":
        return d.cast("date")
    raise ValueError(grain)


def coverage(df: DataFrame, date_col: str, id_col: str, grain: str = "year", by=None,
             approx: bool = False) -> DataFrame:
    """Per period: first/last date, rows, distinct securities."""
    by = _by(by)
    ids = F.approx_count_distinct(id_col) if approx else F.count_distinct(F.col(id_col))
    return (df.withColumn("period", period_col(date_col, grain))
              .groupBy(*by, "period")
              .agg(F.min(F.col(date_col).cast("date")).alias("min_date"),
                   F.max(F.col(date_col).cast("date")).alias("max_date"),
                   F.count(F.lit(1)).alias("rows"),
                   ids.cast("long").alias("securities")))


def coverage_total(df: DataFrame, date_col: str, id_col: str, by=None) -> DataFrame:
    """The total row: distinct securities are not additive, so it is its own agg."""
    return _agg(df, by, [F.min(F.col(date_col).cast("date")).alias("min_date"),
                         F.max(F.col(date_col).cast("date")).alias("max_date"),
                         F.count(F.lit(1)).alias("rows"),
                         F.count_distinct(F.col(id_col)).cast("long").alias("securities")])


def gaps(cov: DataFrame, start: int, end: int, period: str = "period") -> DataFrame:
    """Missing years in ``[start, end]`` merged into runs ``(gap_start, gap_end, years)``.

    Works on the per-period coverage table (one row per year), never on the
    raw data: the expected years are ``range(start, end + 1)``, the missing
    ones an anti join, and runs the classic ``year − row_number()`` islands.
    The window has no partition key, but its input is bounded by the
    requested year range, not by the data.
    """
    from pyspark.sql import Window as W
    spark = cov.sparkSession
    present = cov.select(F.col(period).cast("int").alias("y")).distinct()
    expected = spark.range(start, end + 1).select(F.col("id").cast("int").alias("y"))
    missing = expected.join(present, "y", "left_anti")
    runs = missing.withColumn("_grp", F.col("y") - F.row_number().over(W.orderBy("y")))
    return (runs.groupBy("_grp")
                .agg(F.min("y").alias("gap_start"), F.max("y").alias("gap_end"),
                     F.count(F.lit(1)).cast("int").alias("years"))
                .drop("_grp"))


def anomalies(cov: DataFrame, metric: str = "rows", ratio: float = 0.5, period: str = "period",
              by=None, trailing: int | None = None) -> DataFrame:
    """Year-over-year change of a coverage metric; flag drops and spikes.

    ``flag`` is ``drop`` when the metric falls below ``ratio`` × baseline,
    ``spike`` when above baseline / ``ratio``.  The baseline is the previous
    period, or with ``trailing=k`` the median of the previous k periods.  The
    window runs over the coverage table (one row per period), not raw rows.
    """
    from pyspark.sql import Window as W
    by = _by(by)
    w = W.partitionBy(*by).orderBy(period) if by else W.orderBy(period)
    if trailing:
        # baseline = median of the previous ``trailing`` periods (exact, over the small coverage table)
        prev = F.percentile(F.col(metric).cast("double"), F.lit(0.5)).over(w.rowsBetween(-trailing, -1))
        name = f"trailing_median_{metric}"
    else:
        prev = F.lag(metric).over(w)
        name = f"prev_{metric}"
    chg = F.try_divide(F.col(metric).cast("double"), prev.cast("double"))
    return (cov.select(*by, period, metric, prev.alias(name), F.round(chg, 4).alias("ratio"))
               .withColumn("flag", F.when(F.col("ratio") < ratio, F.lit("drop"))
                           .when(F.col("ratio") > 1.0 / ratio, F.lit("spike"))))


# --- D10 ----------------------------------------------------------------------
def sentinel_census(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-numeric values in numeric-looking text columns: ``(column, code, n)``."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.col(c).cast("string").alias("raw")) for c in cols]))
    return (df.select(cells.alias("_c"))
              .select("_c.column", S.split_code(F.col("_c.raw")).alias("code"))
              .where(F.col("code").isNotNull())
              .groupBy("column", "code").agg(F.count(F.lit(1)).alias("n")))


def split_coded(df: DataFrame, col: str, codes: Sequence[str] | None = None) -> DataFrame:
    """Add ``<col>_num`` (strict numeric) and ``<col>_code`` (the non-numeric text).

    With the documented ``codes`` given, ``<col>_known`` tells them apart from
    other junk (``True`` for a documented code, ``False`` for anything else
    non-numeric, NULL for numbers and blanks), so nothing is lost silently.
    """
    out = df.withColumns({f"{col}_num": S.to_double_or_null(col), f"{col}_code": S.split_code(col)})
    if codes:
        code = F.col(f"{col}_code")
        out = out.withColumn(f"{col}_known", F.when(code.isNotNull(), code.isin(*codes)))
    return out


# --- A22, W1, D11, O5 ---------------------------------------------------------
def duplicate_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def keep_one(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each task sends one row a key and a hot key is reduced on the map side.
    ``order`` should end in a total tie-break for a deterministic result; a
    NULL sorts before any value unless the column expression says otherwise.
    """
    first = Window.partitionBy(*key).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def top_periods(df: DataFrame, period: Column, k: int, name: str = "period") -> DataFrame:
    """Top-k periods by row count (the limit is the feature here)."""
    return (df.groupBy(period.alias(name)).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(name)).limit(k))


# --- A14 ------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 50, by=None) -> DataFrame:
    """Equal-width histogram per group, NULLs dropped.

    Edges come from a min/max aggregate per group (one row per group, joined
    back on the group as one struct, so a NULL group keeps its rows).  The top edge belongs to the last bin; a constant series puts all
    rows into bin 1.  Output: ``bin, lo, hi, n`` with empty bins omitted.
    """
    by = _by(by)
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)]) if by else F.struct(F.lit(0).alias("g0"))
    x = df.select(*by, group.alias("_g"), F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    rng = x.groupBy("_g").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    # one row per group; AQE broadcasts it when small
    j = x.join(rng, "_g", "inner")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)) \
        .otherwise(F.least(F.width_bucket(F.col("_x"), F.col("_lo"), F.col("_hi"), F.lit(bins)), F.lit(bins)))
    return (j.withColumn("bin", b.cast("int"))
             .groupBy(*by, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
             .select(*by, "bin",
                     (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                     F.when(F.col("bin") == bins, F.col("_hi"))
                      .otherwise(F.col("_lo") + F.col("bin") * width).alias("hi"),
                     "n"))


# --- A19, A23 -----------------------------------------------------------------
def table_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and the grand total (``table = '_total'``)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("rows").cast("long").alias("rows")).select(F.lit("_total").alias("table"), "rows")
    return out.unionByName(total)


def end_status_counts(df: DataFrame, end_col: str) -> DataFrame:
    """How many intervals are open (``E``/empty/NULL), dated, or unparseable."""
    status = F.when(S.is_open_end(end_col), F.lit("open")) \
        .when(S.parse_date(end_col).isNotNull(), F.lit("dated")).otherwise(F.lit("invalid"))
    return df.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


# --- A11, O2, O3 ----------------------------------------------------------------
def sorted_codes(df: DataFrame, col: str) -> DataFrame:
    """The distinct codes of a column, sorted (a distributed sort, not a driver list)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def spot_check(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """O3: first ``n`` rows in a stated order (deterministic; planned as a top-k)."""
    return df.orderBy(*order).limit(n)
