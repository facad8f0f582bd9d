"""Property tests: custom operators vs brute force on random data (hot keys, ties, NULLs)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quantlake.operators import asof as A
from quantlake.operators import intervals as IV
from quantlake.operators.quantiles import exact_percentile
from quantlake.operators.quality import keep_one
from quantlake.operators.scan import ordered_scan

BASE = dt.date(2020, 1, 1)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.sampled_from(["hot", "hot", "hot", "a", "b"])           # one key dominates
days = st.integers(min_value=0, max_value=150)                    # several month buckets
vals = st.one_of(st.none(), st.integers(min_value=-50, max_value=50))


@SETTINGS
@given(st.lists(st.tuples(keys, days, vals), min_size=1, max_size=60), st.sampled_from(["last", "sum", "max", "min"]),
       st.booleans(), st.booleans())
def test_ordered_scan_matches_brute_force(spark, rows, op, inclusive, descending):
    data = [(k, BASE + dt.timedelta(days=d), i, v) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d date, i int, v int")
    out = {r.i: r.o for r in ordered_scan(df, ["k"], ["d", "i"], F.col("v"), op, "o", inclusive, descending).collect()}
    for k, d, i, v in data:
        def before(row):
            key = (row[1], row[2])
            me = (d, i)
            return (key < me or (inclusive and key == me)) if not descending else (key > me or (inclusive and key == me))
        seen = sorted([r for r in data if r[0] == k and before(r)], key=lambda r: (r[1], r[2]), reverse=descending)
        xs = [r[3] for r in seen if r[3] is not None]
        want = None
        if xs:
            want = {"last": xs[-1], "sum": sum(xs), "max": max(xs), "min": min(xs)}[op]
        assert out[i] == want, (op, inclusive, descending, k, d, i)


@SETTINGS
@given(st.lists(st.tuples(keys, days), min_size=1, max_size=40), st.lists(st.tuples(keys, days), max_size=40),
       st.booleans(), st.sampled_from(["backward", "forward"]))
def test_asof_matches_brute_force(spark, left, right, strict, direction):
    L = [(k, BASE + dt.timedelta(days=d), i) for i, (k, d) in enumerate(left)]
    R = [(k, BASE + dt.timedelta(days=d), j) for j, (k, d) in enumerate(right)]
    ldf = spark.createDataFrame(L, "k string, d date, lid int")
    rdf = spark.createDataFrame(R, "k string, rd date, rid int") if R else spark.createDataFrame([], "k string, rd date, rid int")
    got = {r.lid: r.rid for r in A.asof_join(ldf, rdf, ["k"], "d", "rd", ["rid"], strict=strict,
                                             direction=direction, tie_break=["rid"]).collect()}
    for k, d, i in L:
        if direction == "backward":
            c = [(rd, j) for kk, rd, j in R if kk == k and (rd < d if strict else rd <= d)]
            want = max(c)[1] if c else None
        else:
            c = [(rd, j) for kk, rd, j in R if kk == k and (rd > d if strict else rd >= d)]
            want = min(c)[1] if c else None
        assert got[i] == want


@SETTINGS
@given(st.lists(st.tuples(keys, days, st.integers(min_value=0, max_value=40)), min_size=1, max_size=40))
def test_merge_intervals_cover_same_days_without_overlap(spark, rows):
    data = [(k, BASE + dt.timedelta(days=s), BASE + dt.timedelta(days=s + n)) for k, s, n in rows]
    out = IV.merge_intervals(spark.createDataFrame(data, "k string, s date, e date"), ["k"], "s", "e").collect()
    for k in {r[0] for r in data}:
        mine = sorted((r.s, r.e) for r in out if r.k == k)
        for (s1, e1), (s2, e2) in zip(mine, mine[1:]):
            assert s2 > e1 + dt.timedelta(days=1)                 # disjoint, not even adjacent
        covered = {s + dt.timedelta(days=x) for kk, s, e in data if kk == k for x in range((e - s).days + 1)}
        merged = {s + dt.timedelta(days=x) for s, e in mine for x in range((e - s).days + 1)}
        assert covered == merged


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(min_value=-20, max_value=20)), min_size=1, max_size=80),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_percentile_matches_interpolation(spark, rows, p):
    df = spark.createDataFrame([(k, float(v)) for k, v in rows], "k string, x double")
    got = {r.k: r.q for r in exact_percentile(df, "x", "k", p, "q").collect()}
    for k in {r[0] for r in rows}:
        xs = sorted(float(v) for kk, v in rows if kk == k)
        pos = (len(xs) - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        want = xs[lo] + (pos - lo) * (xs[hi] - xs[lo])
        assert abs(got[k] - want) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(min_value=0, max_value=5), st.integers(min_value=-2**62, max_value=2**62)), min_size=1, max_size=40))
def test_keep_one_is_min_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v long")
    got = {r.k: (r.o, r.v) for r in keep_one(df, ["k"], ["o", "v"]).collect()}
    for k in {r[0] for r in rows}:
        assert got[k] == min((o, v) for kk, o, v in rows if kk == k)


@SETTINGS
@given(st.lists(st.tuples(keys, days, vals), min_size=1, max_size=50), st.booleans())
def test_multi_scan_equals_single_scans(spark, rows, descending):
    from quantlake.operators.scan import ordered_scans
    data = [(k, BASE + dt.timedelta(days=d), i, v) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d date, i int, v int")
    multi = {r.i: (r.a, r.b, r.c) for r in ordered_scans(
        df, ["k"], ["d", "i"], [(F.col("v"), "last", "a"), (F.col("v"), "sum", "b"), (F.col("v"), "count", "c")],
        inclusive=False, descending=descending).collect()}
    for op, pos in (("last", 0), ("sum", 1), ("count", 2)):
        single = {r.i: r.o for r in ordered_scan(df, ["k"], ["d", "i"], F.col("v"), op, "o", False, descending).collect()}
        assert all(multi[i][pos] == single[i] for i in single), op


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(min_value=0, max_value=10**6), vals), min_size=1, max_size=50))
def test_ordered_scan_numeric_order_auto_bucket(spark, rows):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t long, i int, v int")
    out = {r.i: r.o for r in ordered_scan(df, ["k"], ["t", "i"], F.col("v"), "sum", "o", inclusive=True).collect()}
    for k, t, i, v in data:
        xs = [vv for kk, tt, ii, vv in data if kk == k and (tt, ii) <= (t, i) and vv is not None]
        assert out[i] == (sum(xs) if xs else None)
