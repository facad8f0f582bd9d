"""Validity-interval operators: interval join, membership filter, exclusion, merge.

An equi join on the key with the interval as a residual condition compares every
fact row with every interval of its key.  Neither form here does:

* a small interval table (size checked) becomes one sorted list a key, broadcast;
  a binary search finds the few intervals that can hold the row's day, and no
  fact row is shuffled;
* otherwise facts and sorted lists meet by a shuffle on the key, each moved once;
* but where a key has more than ``LONG`` intervals, too many for a list, each goes into one or
  two time bins as wide as itself (widths are powers of eight days), and the distinct
  (key, day) pairs of that key's facts look into their bin of each width; key, width and bin
  are the equi key, so a hot key is dealt out by time.  The pairs' matches meet the facts on (key, day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quantlake.functions.scalars import LINK_OPEN_VALUES, OPEN_END_DATE, link_end
from quantlake.operators.joins import FILE_EXPANSION
from quantlake.operators.scan import input_bytes, ordered_scan


def end_date(df: DataFrame, end: str, open_values: Sequence[str] = LINK_OPEN_VALUES) -> Column:
    """Interval end as a date: text ends use the open markers, NULL is open."""
    if isinstance(df.schema[end].dataType, StringType):
        return link_end(end, open_values)
    return F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END_DATE).cast("date"))


def _inside(at: Column, s: Column, e: Column, closed: str) -> Column:
    lo = at >= s if closed in ("both", "left") else at > s
    hi = at <= e if closed in ("both", "right") else at < e
    return lo & hi


#: Bins of the widest kind hold 8**8 days; no two dates lie further apart.
_KINDS = range(8)


def _sorted_lists(d: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key: its intervals by start, each with the greatest end up to it (``m``, which never falls)."""
    w = Window.partitionBy(*keys).orderBy("_s", "_e")
    d = d.withColumns({"_n": F.row_number().over(w), "_m": F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    # n is unique in a key, so the order never looks further
    item = F.struct(F.col("_n").alias("n"), F.col("_s").alias("s"), F.col("_e").alias("e"), F.col("_m").alias("m"), F.col("_p").alias("p"))
    return d.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_list"))


#: Lists of so many intervals are looked through as they are.
_SHORT = 16


def _first_place(list_: Column, is_before) -> Column:
    """How many intervals at the front of ``list_`` fulfil ``is_before``, by binary search."""
    steps = F.sequence(F.floor(F.log2(F.size(list_))).cast("int"), F.lit(0), F.lit(-1))
    return F.aggregate(steps, F.lit(0), lambda at, i: F.when(
        F.coalesce(is_before(F.get(list_, at + F.call_function("shiftleft", F.lit(1), i) - 1)), F.lit(False)), at + F.call_function("shiftleft", F.lit(1), i)).otherwise(at))


def _by_lists(fact: DataFrame, d: DataFrame, keys: dict, at: str, closed: str, how: str, columns: Sequence[str], small: bool) -> DataFrame:
    lists = _sorted_lists(d, list(keys.values()))
    needs_list = "inner" if how in ("inner", "left_semi") else "left"
    j = fact.join(F.broadcast(lists) if small else lists, [fact[k] == lists[v] for k, v in keys.items()], needs_list).drop(*keys.values())
    day, all_ = F.col(at).cast("date"), F.col("_list")
    over = (lambda x: x["m"] < day) if closed in ("both", "right") else (lambda x: x["m"] <= day)
    begun = (lambda x: x["s"] <= day) if closed in ("both", "left") else (lambda x: x["s"] < day)
    bounds = F.struct(_first_place(all_, over).alias("lo"), _first_place(all_, begun).alias("hi"))
    # bounds are bound to a variable, so they are worked out once
    cut = F.transform(F.array(bounds), lambda b: F.slice(all_, b["lo"] + 1, F.greatest(b["hi"] - b["lo"], F.lit(0))))[0]
    near = F.when(F.size(all_) <= _SHORT, all_).when(F.size(all_) > _SHORT, cut)
    hits = F.filter(near, lambda x: _inside(day, x["s"], x["e"], closed))
    if how in ("left_semi", "left_anti"):
        some = F.coalesce(F.size(hits), F.lit(0)) > 0
        return j.where(some if how == "left_semi" else ~some).drop("_list")
    # an outer generator and a filter behind it: a filter before it would work the hits out twice
    j = j.select(*fact.columns, F.explode_outer(hits).alias("_hit"))
    if how == "inner":
        j = j.where("_hit IS NOT NULL")
    return j.select(*fact.columns, *[F.col("_hit")["p"][c].alias(c) for c in columns])


def _bin(day: Column, kind: Column) -> Column:
    return F.floor(F.unix_date(day) / F.pow(F.lit(8.0), kind + 1)).cast("int")


def _kind() -> Column:
    """The kind of an interval: its bins are at least as wide as itself, and less than eight times as wide (or eight days)."""
    return sum(((F.datediff("_e", "_s") >= F.lit(8 ** (k + 1))).cast("int") for k in _KINDS[:-1]), F.lit(0))


def _binned(d: DataFrame) -> DataFrame:
    """Intervals with ``_kind`` and each ``_bin`` they touch, two at most."""
    d = d.where(F.datediff("_e", "_s") >= 0).withColumn("_kind", _kind())
    return d.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_s"), F.col("_kind")), _bin(F.col("_e"), F.col("_kind")))))


def _asked(fact: DataFrame, d: DataFrame, keys: dict, at: str) -> DataFrame:
    """The facts' distinct (key, day) pairs, with the ``_bin`` of each kind that occurs in ``d``."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    kinds = d.where(F.datediff("_e", "_s") >= 0).agg(F.collect_set(_kind()).alias("k")).scalar()          # eight at most
    # any one row of the pair, whole: pairs and facts then need the same columns of the facts' exchanges, which are reused;
    # a NULL day stays (its bin is NULL) for the same reason
    pairs = (fact.where(known).groupBy(*[F.col(k).alias(v) for k, v in keys.items()], F.col(at).cast("date").alias("_at"))
             .agg(F.first(F.struct(*fact.columns)).alias("_one")).where("_one IS NOT NULL").drop("_one"))
    return pairs.withColumn("_kind", F.explode(kinds)).withColumn("_bin", _bin(F.col("_at"), F.col("_kind")))


def _by_bins(fact: DataFrame, d: DataFrame, keys: dict, at: str, closed: str, how: str, columns: Sequence[str]) -> DataFrame:
    names = list(keys.values())
    semi = how in ("left_semi", "left_anti")
    hits = _asked(fact, d, keys, at).join(_binned(d), [*names, "_kind", "_bin"]).where(F.coalesce(_inside(F.col("_at"), F.col("_s"), F.col("_e"), closed), F.lit(False)))
    hits = hits.select(*names, "_at").distinct() if semi else hits.select(*names, "_at", "_p")
    j = fact.join(hits, [fact[k] == hits[v] for k, v in keys.items()] + [fact[at].cast("date") == hits["_at"]], how)
    return j if semi else j.select(*[fact[c] for c in fact.columns], *[F.col("_p")[c].alias(c) for c in columns])


def _intervals(dim: DataFrame, names: dict, start: str, end: str, open_values: Sequence[str], payload: Column) -> DataFrame:
    """The keys under new names, ``_s``, ``_e`` and ``_p`` of the intervals with a key and a start."""
    d = dim.select(*[F.col(c).alias(n) for n, c in names.items()], F.col(start).cast("date").alias("_s"),
                   end_date(dim, end, open_values).alias("_e"), payload.alias("_p"))
    known = F.col("_s").isNotNull()
    for n in names:
        known = known & F.col(n).isNotNull()
    return d.where(known)          # an end that is no date fits no day below


#: Keys with more intervals than these are dealt out by time.
LONG = 4096


def _long_keys(d: DataFrame, names: Sequence[str]):
    """A function that gives the rows of a frame whose key (its columns ``cols``) has more than ``LONG`` intervals, or the others."""
    long = F.broadcast(d.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LONG).select(*names))

    def only(df: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
        return df.join(long, [df[c] == long[n] for c, n in zip(cols, names)], how)

    return only


def _by_key(fact: DataFrame, d: DataFrame, keys: dict, at: str, closed: str, how: str, columns: Sequence[str]) -> DataFrame:
    """Lists for all keys but those with more than ``LONG`` intervals, which bins serve; one key in ``LONG`` intervals at most."""
    names = list(keys.values())
    if how in ("inner", "left_semi"):
        for c in (at, *keys):
            fact = fact.where(F.col(c).isNotNull())
    only = _long_keys(d, names)
    lists = _by_lists(only(fact, list(keys), "left_anti"), only(d, names, "left_anti"), keys, at, closed, how, columns, False)
    bins = _by_bins(only(fact, list(keys), "left_semi"), only(d, names, "left_semi"), keys, at, closed, how, columns)
    return lists.unionByName(bins)


def interval_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | dict, at: str, start: str, end: str,
                  closed: str = "both", how: str = "left", open_values: Sequence[str] = LINK_OPEN_VALUES,
                  dim_cols: Sequence[str] | None = None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Fact rows joined to the dim row whose [start, end] holds ``at``.

    ``on`` maps fact key columns to dim key columns (a list means same names).
    Validity is in days: ``at`` and the interval bounds are compared as dates.
    ``how`` is ``left``/``inner`` (attach attributes) or ``left_semi`` /
    ``left_anti`` (membership filter).  Overlapping dim intervals fan out,
    exactly as the SQL join would.  A NULL key, day or start matches nothing, a NULL end is open.

    A dim whose tables take at most ``broadcast_bytes`` in all, expanded, is
    broadcast as sorted lists; the lists of a larger one move by key, and keys with very many
    intervals are cut into bins (see the module).
    A streaming fact always meets lists, as a stream is not read twice; a key's
    intervals then have to fit into a row.
    """
    pairs = dict(on) if isinstance(on, dict) else {k: k for k in on}
    keys = {k: f"_k{i}" for i, k in enumerate(pairs)}
    semi = how in ("left_semi", "left_anti")
    keep = [] if semi else list(dim_cols if dim_cols is not None else [c for c in dim.columns if c not in pairs.values()])
    payload = F.struct(*[F.col(c).alias(c) for c in keep]) if keep else F.struct(F.lit(0).alias("_none"))
    d = _intervals(dim, {keys[k]: v for k, v in pairs.items()}, start, end, open_values, payload)
    small = not dim.isStreaming and input_bytes(d) * FILE_EXPANSION <= broadcast_bytes
    if small or fact.isStreaming:
        return _by_lists(fact, d, keys, at, closed, how, keep, small)
    return _by_key(fact, d, keys, at, closed, how, keep)


def compose_links(first: DataFrame, second: DataFrame, via: Sequence[str], start: str, end: str,
                  open_values: Sequence[str] = LINK_OPEN_VALUES) -> DataFrame:
    """Two dated link tables as one: ids of both, valid where both links are.

    ``via`` are the columns that both have (the id in the middle); ``start`` and ``end`` are
    those columns' names in both and in the result, whose interval is the intersection, as dates (an
    open end is far in the future).  So a chain of links is itself an interval table, and may
    be composed further or joined by :func:`interval_join`.  A NULL id or start links nothing.
    """
    via = list(via)
    a = first.withColumns({start: F.col(start).cast("date"), end: end_date(first, end, open_values)})
    b = second.select(*via, *[c for c in second.columns if c not in (*via, start, end)], F.col(start).cast("date").alias("_s2"),
                      end_date(second, end, open_values).alias("_e2"))
    j = a.join(b, via).where((F.col("_s2") <= F.col(end)) & (F.col("_e2") >= F.col(start)))
    return j.withColumns({start: F.greatest(start, "_s2"), end: F.least(end, "_e2")}).drop("_s2", "_e2")


def exclude_windows(df: DataFrame, win: DataFrame, on: Sequence[str], at: str, start: str, end: str,
                    closed: str = "both") -> DataFrame:
    """Drop rows whose ``at`` falls inside an exclusion window of the same key.

    A missing or far-future end keeps the window open.
    """
    return interval_join(df, win, list(on), at, start, end, closed=closed, how="left_anti", dim_cols=[])


def exclude_days(df: DataFrame, days: str, out: str, win: DataFrame, on: Sequence[str], start: str, end: str,
                 broadcast_bytes: int = 64 << 20) -> DataFrame:
    """J16 before a generator: a row with each day of the array ``days`` that no window of its key holds, as ``out``.

    The same as :func:`exclude_windows` behind ``explode(days)``, but rows meet the windows once each, not once a day.
    """
    keys = {k: f"_k{i}" for i, k in enumerate(on)}
    names = list(keys.values())
    columns = [c for c in df.columns if c != days]
    d = _intervals(win, {n: k for k, n in keys.items()}, start, end, LINK_OPEN_VALUES, F.struct(F.lit(0).alias("_none"))).where(F.col("_e").isNotNull())

    def by_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
        j = rows.join(lists, [rows[k] == lists[n] for k, n in keys.items()], "left")
        # held: the greatest end of the windows that have begun (a place beyond the front gives NULL)
        begun = lambda t: _first_place(F.col("_list"), lambda x: x["s"] <= t)
        held = lambda t: F.coalesce(F.get(F.col("_list"), begun(t) - 1)["m"] >= t, F.lit(False))
        free = F.when(F.col("_list").isNull(), F.col(days)).otherwise(F.filter(F.col(days), lambda t: ~held(t)))
        # moved once more before they are multiplied, and every aggregate of the result reads them there
        return j.select(*columns, free.alias(days)).repartition(*columns).select(*columns, F.explode(days).alias(out))

    if input_bytes(d) * FILE_EXPANSION <= broadcast_bytes:
        return by_lists(df, F.broadcast(_sorted_lists(d, names)))
    only = _long_keys(d, names)
    free = by_lists(only(df, list(on), "left_anti"), _sorted_lists(only(d, names, "left_anti"), names))
    each = only(df, list(on), "left_semi").select(*columns, F.explode(days).alias(out))
    return free.unionByName(_by_bins(each, only(d, names, "left_semi"), keys, out, "both", "left_anti", []))


def merge_intervals(df: DataFrame, key: Sequence[str], start: str, end: str, gap_days: int = 1) -> DataFrame:
    """Merge overlapping or adjacent intervals per key.

    Intervals are ordered by (start, end); a new island starts when the
    start lies more than ``gap_days`` after the running maximum end of the
    earlier intervals.  Both running values are :func:`ordered_scan` passes
    (split by month), then one grouped aggregate per island.
    """
    key = list(key)
    d = df.select(*key, F.col(start).cast("date").alias("_s"),
                  F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END_DATE).cast("date")).alias("_e"))
    d = ordered_scan(d, key, ["_s", "_e"], F.col("_e"), "max", "_prev_end", inclusive=False)
    d = d.withColumn("_new", F.when(F.col("_prev_end").isNull()
                                    | (F.col("_s") > F.date_add("_prev_end", gap_days)), 1).otherwise(0))
    d = ordered_scan(d, key, ["_s", "_e"], F.col("_new"), "sum", "_island", inclusive=True)
    return (d.groupBy(*key, "_island")
             .agg(F.min("_s").alias(start), F.max("_e").alias(end), F.count(F.lit(1)).alias("n_merged"))
             .drop("_island"))
