"""As-of, stops, intervals, scans and split factors — against brute force, incl. a hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quantlake.operators import adjust as ADJ
from quantlake.operators import asof as A
from quantlake.operators import intervals as IV
from quantlake.operators.scan import ordered_scan

D = dt.date


def test_asof_inclusive_vs_strict_no_lookahead(spark):
    left = spark.createDataFrame([("T", D(2020, 1, 5)), ("T", D(2020, 1, 10)), ("U", D(2020, 1, 1))], "k string, d date")
    right = spark.createDataFrame([("T", D(2020, 1, 5), 1.0), ("T", D(2020, 1, 7), 2.0), ("T", D(2020, 1, 11), 9.0)],
                                  "k string, rd date, v double")
    inc = {(r.k, str(r.d)): r.v for r in A.asof_join(left, right, ["k"], "d", "rd", ["v"]).collect()}
    st = {(r.k, str(r.d)): r.v for r in A.asof_join(left, right, ["k"], "d", "rd", ["v"], strict=True).collect()}
    assert inc == {("T", "2020-01-05"): 1.0, ("T", "2020-01-10"): 2.0, ("U", "2020-01-01"): None}
    assert st == {("T", "2020-01-05"): None, ("T", "2020-01-10"): 2.0, ("U", "2020-01-01"): None}
    fw = {str(r.d): r.v for r in A.asof_join(left, right, ["k"], "d", "rd", ["v"], direction="forward").collect()}
    assert fw["2020-01-05"] == 1.0 and fw["2020-01-10"] == 9.0


def test_asof_hot_key_many_buckets_matches_brute_force(spark):
    rnd = random.Random(7)
    base = D(2019, 1, 1)
    L = [("HOT" if i % 3 else f"k{i % 5}", base + dt.timedelta(days=rnd.randrange(700)), i) for i in range(3000)]
    R = [("HOT" if i % 2 else f"k{i % 5}", base + dt.timedelta(days=rnd.randrange(700)), float(i)) for i in range(800)]
    left = spark.createDataFrame(L, "k string, d date, lid int")
    right = spark.createDataFrame(R, "k string, rd date, v double")
    got = {r.lid: r.v for r in A.asof_join(left, right, ["k"], "d", "rd", ["v"], tie_break=["v"]).collect()}
    for k, d, lid in L:
        cands = [(rd, v) for rk, rd, v in R if rk == k and rd <= d]
        want = max(cands)[1] if cands else None
        assert got[lid] == want


def test_ordered_scan_sum_and_max_cross_buckets(spark):
    rows = [("a", D(2020, m, 1 + (i % 27)), i) for m in range(1, 13) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, d date, x int")
    out = ordered_scan(df, ["k"], ["d", "x"], F.col("x"), "sum", "s", inclusive=False)
    got = {(str(r.d), r.x): r.s for r in out.collect()}
    for k, d, x in rows:
        before = [xx for kk, dd, xx in rows if (dd, xx) < (d, x)]
        assert got[(str(d), x)] == (sum(before) if before else None)


def test_apply_stops_and_valid_to(spark):
    est = spark.createDataFrame([("T", D(2020, 1, 1)), ("T", D(2020, 3, 1))], "k string, act date")
    stops = spark.createDataFrame([("T", D(2020, 2, 1)), ("T", D(2020, 3, 1))], "k string, stop date")
    got = {str(r.act): str(r.valid_to) for r in A.apply_stops(est, stops, ["k"], "act", "stop").collect()}
    assert got == {"2020-01-01": "2020-02-01", "2020-03-01": "2020-03-01"}
    v = {str(r.act): r.valid_to for r in A.valid_to_next(est, ["k"], "act").collect()}
    assert str(v["2020-01-01"]) == "2020-02-29" and v["2020-03-01"] is None


def test_interval_join_open_end_and_exclusion(spark):
    fact = spark.createDataFrame([("g1", D(2020, 1, 5)), ("g1", D(2030, 1, 1)), ("g2", D(2020, 1, 1))], "g string, d date")
    link = spark.createDataFrame([("g1", 7, D(2019, 1, 1), "2020-01-31"), ("g1", 8, D(2020, 2, 1), "E")],
                                 "g string, permno int, s date, e string")
    got = sorted((r.g, str(r.d), r.permno) for r in IV.interval_join(fact, link, ["g"], "d", "s", "e", dim_cols=["permno"]).collect())
    assert got == [("g1", "2020-01-05", 7), ("g1", "2030-01-01", 8), ("g2", "2020-01-01", None)]
    win = spark.createDataFrame([("g1", D(2020, 1, 1), None)], "g string, xs date, xe date")
    kept = IV.exclude_windows(fact, win, ["g"], "d", "xs", "xe")   # NULL end = still excluded
    assert sorted(r.g for r in kept.collect()) == ["g2"]


def test_merge_intervals_no_overlap(spark):
    rows = [("a", D(2020, 1, 1), D(2020, 1, 10)), ("a", D(2020, 1, 11), D(2020, 1, 20)),
            ("a", D(2020, 3, 1), D(2020, 3, 5)), ("a", D(2020, 3, 2), D(2020, 3, 3)), ("b", D(2020, 1, 1), None)]
    out = IV.merge_intervals(spark.createDataFrame(rows, "k string, s date, e date"), ["k"], "s", "e")
    got = sorted((r.k, str(r.s), str(r.e), r.n_merged) for r in out.collect())
    assert got == [("a", "2020-01-01", "2020-01-20", 2), ("a", "2020-03-01", "2020-03-05", 2),
                   ("b", "2020-01-01", "9999-12-31", 1)]


def test_split_day_is_strict_and_roundtrip(spark):
    splits = spark.createDataFrame([("T", D(2020, 6, 1), 2.0), ("T", D(2021, 1, 1), 3.0)], "TICKER string, SPDATES date, ADJ double")
    vals = spark.createDataFrame([("T", D(2020, 1, 1), 6.0), ("T", D(2020, 6, 1), 6.0), ("T", D(2021, 6, 1), 6.0),
                                  ("X", D(2020, 1, 1), 6.0)], "TICKER string, d date, v double")
    un = {(r.TICKER, str(r.d)): r.v for r in ADJ.unadjust(vals, splits, ["TICKER"], "d", ["v"]).collect()}
    assert un == {("T", "2020-01-01"): 36.0, ("T", "2020-06-01"): 18.0, ("T", "2021-06-01"): 6.0, ("X", "2020-01-01"): 6.0}
    back = ADJ.adjust(ADJ.unadjust(vals, splits, ["TICKER"], "d", ["v"]).drop("cum_adj"), splits, ["TICKER"], "d", ["v"])
    assert all(abs(r.v - 6.0) < 1e-12 for r in back.collect())


def test_asof_grain_does_not_change_results(spark):
    from quantlake.operators.scan import time_bucket
    rnd = random.Random(5)
    base = dt.datetime(2020, 1, 1)
    L = [("HOT" if i % 4 else "c", base + dt.timedelta(hours=rnd.randrange(2000)), i) for i in range(600)]
    R = [("HOT" if i % 3 else "c", base + dt.timedelta(hours=rnd.randrange(2000)), i) for i in range(300)]
    left = spark.createDataFrame(L, "k string, t timestamp_ntz, lid int")
    right = spark.createDataFrame(R, "k string, rt timestamp_ntz, rid int")
    results = []
    for grain in ("month", "day", "hour"):
        j = A.asof_join(left, right, ["k"], "t", "rt", ["rid"], tie_break=["rid"], bucket=time_bucket(grain))
        results.append(sorted((r.lid, r.rid) for r in j.collect()))
    assert results[0] == results[1] == results[2]


def test_stops_join_on_mapped_periodicity(spark):
    from quantlake.functions.scalars import periodicity_1char
    est = spark.createDataFrame([("T", "ANN", D(2020, 1, 1)), ("T", "QTR", D(2020, 1, 1))], "k string, p string, act date")
    stops = spark.createDataFrame([("T", "A", D(2020, 5, 1))], "k string, p string, stop date")
    e = est.withColumn("p1", periodicity_1char("p"))
    s = stops.withColumn("p1", periodicity_1char("p")).drop("p")
    got = {r.p: r.valid_to for r in A.apply_stops(e, s, ["k", "p1"], "act", "stop").collect()}
    assert str(got["ANN"]) == "2020-05-01" and got["QTR"] is None


def test_index_returns_with_lagged_cap(spark):
    from quantlake.operators.panel import index_returns
    rows = [("a", D(2020, 1, 1), 0.1, 100.0), ("b", D(2020, 1, 1), 0.2, 300.0),
            ("a", D(2020, 1, 2), 0.0, 110.0), ("b", D(2020, 1, 2), 0.1, 360.0)]
    df = spark.createDataFrame(rows, "k string, d date, r double, cap double")
    got = {str(x.d): x for x in index_returns(df, "d", "r", "cap", lag_by=["k"]).collect()}
    assert got["2020-01-01"].vwret is None                      # no earlier cap known
    assert abs(got["2020-01-02"].vwret - (0.0 * 100 + 0.1 * 300) / 400) < 1e-12
    assert abs(got["2020-01-02"].ewret - 0.05) < 1e-12


def test_lagged_return_with_split_factor(spark):
    from quantlake.operators.panel import lagged
    # cumulative factor: 2 before a 2:1 split, 1 after (adjusted price = price / factor)
    rows = [("a", D(2020, 1, 1), 100.0, 2.0, None), ("a", D(2020, 1, 2), 51.0, 1.0, 0.02),
            ("a", D(2020, 1, 3), 76.5, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "k string, d date, p double, f double, ret double")
    got = {str(r.d): r for r in lagged(df, ["k"], "d", "p", stored_ret="ret", factor="f").collect()}
    assert got["2020-01-01"].ret_p is None and got["2020-01-02"].prev_p == 100.0
    assert abs(got["2020-01-02"].ret_p - 0.02) < 1e-12 and got["2020-01-02"].ret_matches   # 2:1 split
    assert got["2020-01-03"].ret_matches is True


def test_asof_date_against_timestamp_uses_midnight(spark):
    left = spark.createDataFrame([("k", D(2020, 1, 2))], "k string, d date")
    right = spark.createDataFrame([("k", dt.datetime(2020, 1, 1, 23, 0), 1), ("k", dt.datetime(2020, 1, 2, 10, 0), 2)],
                                  "k string, rt timestamp_ntz, rid int")
    assert A.asof_join(left, right, ["k"], "d", "rt", ["rid"]).first().rid == 1      # 10:00 on the 2nd is later
    fw = A.asof_join(left, right, ["k"], "d", "rt", ["rid"], direction="forward").first()
    assert fw.rid == 2 and str(fw.d) == "2020-01-02"                                # left keeps its own type


def test_estimate_panel_with_stops_and_exclusions(spark):
    est = spark.createDataFrame([
        ("EPS", "a1", D(2020, 1, 15), 1.0, 1), ("EPS", "a1", D(2020, 5, 20), 2.0, 2),   # revision in May
        ("EPS", "a2", D(2020, 2, 1), 5.0, 3),                                            # stopped in August
        ("EPS", "a3", D(2020, 1, 1), 9.0, 4)],                                           # excluded Q2 start
        "measure string, est string, d date, v double, id int")
    stops = spark.createDataFrame([("EPS", "a2", D(2020, 8, 1))], "measure string, est string, stop date")
    excl = spark.createDataFrame([("EPS", "a3", D(2020, 3, 15), D(2020, 4, 15))],
                                 "measure string, est string, xs date, xe date")
    panel = A.estimate_panel(est, ["measure"], "est", "d", "v", end="2020-12-31", stops=stops, stop_at="stop",
                             excluded=excl, exc_start="xs", exc_end="xe", tie_break=["id"])
    got = sorted((r.est, str(r.obs_date), r.value) for r in panel.collect())
    q = ["2020-04-01", "2020-07-01", "2020-10-01"]
    want = sorted([("a1", q[0], 1.0), ("a1", q[1], 2.0), ("a1", q[2], 2.0),
                   ("a2", q[0], 5.0), ("a2", q[1], 5.0),
                   ("a3", "2020-01-01", 9.0), ("a3", q[1], 9.0), ("a3", q[2], 9.0)])   # live on its own quarter start
    assert got == want
    cons = {str(r.obs_date): r for r in A.consensus(panel, ["measure", "obs_date"]).collect()}
    assert cons["2020-07-01"].n_est == 3 and cons["2020-07-01"].median_est == 5.0
    assert cons["2020-10-01"].n_est == 2 and cons["2020-10-01"].mean_est == 5.5


def test_auto_grain_splits_a_hot_key(spark):
    from quantlake.operators.scan import auto_grain
    base = dt.datetime(2020, 1, 1)
    hot = [("HOT", base + dt.timedelta(minutes=i), i) for i in range(3000)]        # ~2 days, dense
    cold = [(f"c{i % 7}", base + dt.timedelta(days=i), i) for i in range(300)]
    df = spark.createDataFrame(hot + cold, "k string, t timestamp_ntz, i int")
    assert auto_grain(df, ["k"], "t", target_rows=100) == "hour"
    assert auto_grain(df, ["k"], "t", target_rows=10**7) == "month"
    right = spark.createDataFrame([(k, t, i) for k, t, i in hot[::7] + cold[::3]], "k string, rt timestamp_ntz, rid int")
    a = sorted((tuple(r) for r in A.asof_join(df, right, ["k"], "t", "rt", ["rid"], bucket="auto").select("i", "rid").collect()), key=str)
    b = sorted((tuple(r) for r in A.asof_join(df, right, ["k"], "t", "rt", ["rid"]).select("i", "rid").collect()), key=str)
    assert a == b


def test_cumulative_return_wipe_out_and_zero_price(spark):
    from quantlake.operators.panel import cumulative_return, lagged
    rows = [("a", D(2020, 1, d), p) for d, p in ((1, 10.0), (2, 11.0), (3, 0.0), (4, 5.0), (5, 6.0))]
    df = lagged(spark.createDataFrame(rows, "k string, d date, p double"), ["k"], "d", "p")
    out = {str(r.d): r for r in cumulative_return(df, ["k"], "d", "ret_p").collect()}
    assert abs(out["2020-01-02"].cum_ret - 0.1) < 1e-12
    assert out["2020-01-03"].cum_ret == -1.0                        # -100 % is not skipped
    assert out["2020-01-04"].ret_p is None and out["2020-01-04"].cum_ret == -1.0   # return over a zero price: NULL
    assert out["2020-01-05"].cum_ret == -1.0 and out["2020-01-05"].n_missing == 2


def test_interval_join_both_forms_equal_brute_force(spark):
    rnd = random.Random(1)
    base = D(2000, 1, 1)
    day = lambda n: base + dt.timedelta(days=n)
    facts = [(rnd.choice(["a", "a", "b", None]), None if rnd.random() < 0.05 else day(rnd.randrange(-50, 3000)), i) for i in range(200)] + [("a", day(5), 0)] * 2
    dims = []
    for i in range(150):
        s, n = rnd.randrange(3000), rnd.choice([0, 1, 7, 8, 63, 64, 500, 3000, -3])
        dims.append((rnd.choice(["a", "b", "c", None]), i, day(s) if rnd.random() > 0.03 else None,
                     rnd.choice(["E", None, "junk", str(day(s + n)), str(day(s + n))])))
    f, g = spark.createDataFrame(facts, "k string, d date, i int"), spark.createDataFrame(dims, "k string, p int, s date, e string")

    def end(e):
        return D(9999, 12, 31) if e in (None, "E") else None if e == "junk" else dt.date.fromisoformat(e)

    def holds(d, s, e, closed):
        if d is None or s is None or e is None:
            return False
        return (d >= s if closed in ("both", "left") else d > s) and (d <= e if closed in ("both", "right") else d < e)

    for closed, how in (("both", "left"), ("left", "inner"), ("right", "left_semi"), ("both", "left_anti")):
        want = []
        for k, d, i in facts:
            m = [p for kk, p, s, e in dims if k is not None and kk == k and holds(d, s, end(e), closed)]
            if how in ("left", "inner"):
                want += [(k, d, i, p) for p in (m or ([None] if how == "left" else []))]
            elif (how == "left_semi") == bool(m):
                want.append((k, d, i))
        for limit in (0, 1 << 70):                                       # bins, sorted lists
            got = IV.interval_join(f, g, ["k"], "d", "s", "e", closed=closed, how=how, dim_cols=["p"], broadcast_bytes=limit).collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str), (closed, how, limit)


def test_interval_bins_compare_few_pairs(spark):
    """One key with 10,000 days asked and 10,000 intervals in a row: fewer than 20 pairs a row before the dates are compared."""
    facts = spark.range(10000).select(F.lit("k").alias("k"), F.expr("date_add(date'1940-01-01', cast(3 * id + id % 3 as int))").alias("d"))
    dims = spark.range(10000).select(F.lit("k").alias("_k0"), F.expr("date_add(date'1940-01-01', cast(3 * id as int))").alias("_s"),
                                     F.expr("date_add(date'1940-01-01', cast(3 * id + 2 as int))").alias("_e"), F.struct("id").alias("_p"))
    # some wide ones and open ends among them
    dims = dims.unionByName(spark.range(20).select(F.lit("k").alias("_k0"), F.expr("date_add(date'1940-01-01', cast(900 * id as int))").alias("_s"),
                                                   F.expr("CASE WHEN id % 10 = 0 THEN date'9999-12-31' ELSE date_add(date'1940-01-01', cast(900 * id + 899 as int)) END").alias("_e"),
                                                   F.struct("id").alias("_p")))
    pairs = IV._asked(facts, dims, {"k": "_k0"}, "d").join(IV._binned(dims), ["_k0", "_kind", "_bin"])
    assert pairs.where("_at BETWEEN _s AND _e").count() > 10000 and pairs.count() < 20 * 10000


def test_composed_links_hold_where_both_hold(spark):
    a = spark.createDataFrame([("b1", "i1", D(2000, 1, 1), "2005-12-31"), ("b2", "i1", D(2003, 1, 1), "E"), (None, "i1", D(2000, 1, 1), "E")],
                              "bond string, issuer string, s date, e string")
    b = spark.createDataFrame([("i1", "g1", D(1999, 1, 1), "2003-06-30"), ("i1", "g2", D(2003, 7, 1), None), (None, "g3", D(1999, 1, 1), "E")],
                              "issuer string, gvkey string, s date, e string")
    got = sorted((r.bond, r.gvkey, str(r.s), str(r.e)) for r in IV.compose_links(a, b, ["issuer"], "s", "e").where("bond IS NOT NULL").collect())
    assert got == [("b1", "g1", "2000-01-01", "2003-06-30"), ("b1", "g2", "2003-07-01", "2005-12-31"),
                   ("b2", "g1", "2003-01-01", "2003-06-30"), ("b2", "g2", "2003-07-01", "9999-12-31")]


def test_left_time_of_unknown_date_gets_no_stop(spark):
    est = spark.createDataFrame([("T", D(1970, 1, 1)), ("T", D(2009, 1, 1))], "k string, act date")
    stops = spark.createDataFrame([("T", D(2010, 1, 1))], "k string, stop date")
    assert {str(r.act): r.valid_to for r in A.apply_stops(est, stops, ["k"], "act", "stop").collect()} == {"1970-01-01": None, "2009-01-01": D(2010, 1, 1)}


def test_split_product_over_many_buckets(spark):
    """200 splits of one ticker over some 40 buckets, one NULL factor, against brute force; a zero stays zero."""
    rnd = random.Random(2)
    rows = [("T", D(1990, 1, 1) + dt.timedelta(days=40 * i), rnd.choice([2.0, 0.5, 1.0, 4.0, 0.25, None]), i) for i in range(200)] + [("Z", D(2000, 1, 1), 0.0, 0), ("Z", D(2001, 1, 1), 3.0, 1)]
    df = spark.createDataFrame(rows, "k string, d date, adj double, i int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {(r.k, r.i): r.cum_adj for r in ADJ.split_factor(df, ["k"], "d", "adj", ["i"], bucket="range").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for k, _, _, i in rows:
        want = 1.0
        for kk, _, adj, ii in rows:
            if kk == k and ii >= i and adj is not None:
                want *= adj
        assert got[k, i] == want


def test_range_buckets_split_one_instant(spark):
    """Rows of one key at one time are cut by the tie-break; all forms of bucket give the same."""
    from quantlake.operators.scan import _range_bucket, ordered_scans
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(D(2020, 1, 1)).alias("d"), F.col("id").alias("i"), (F.col("id") % 7).alias("v"))
    sizes = [r["count"] for r in _range_bucket(df, ["k", "d", "i"]).groupBy("_bk").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 3000
    aggs = [(F.col("v"), "sum", "s"), (F.col("v"), "last", "l")]
    a, b = (sorted(map(tuple, ordered_scans(df, ["k"], ["d", "i"], aggs, False, bucket=how).collect())) for how in ("range", "key"))
    assert a == b


def _random_intervals(spark, hot: int):
    import random
    r = random.Random(5)
    day = lambda: D(2000, 1, 1) + dt.timedelta(days=r.randrange(900))
    facts = [(i, r.choice(["a", "b", "c", "hot", None]), r.choice([None, day(), day()])) for i in range(120)]
    dims = [(k, s, r.choice([None, s + dt.timedelta(days=r.randrange(-3, 90))]), j)
            for j, (k, s) in enumerate((r.choice(["a", "b", None]), day()) for _ in range(20))]
    dims += [("hot", s, s + dt.timedelta(days=r.randrange(0, 40)), 100 + j) for j, s in enumerate(day() for _ in range(hot))]
    return facts, dims, spark.createDataFrame(facts, "i long, k string, d date"), spark.createDataFrame(dims, "k string, s date, e date, p long")


def test_large_dim_moves_facts_once_and_cuts_only_long_keys(spark, monkeypatch):
    """Keys with few intervals meet as lists, a key with more than LONG in bins; together they equal brute force."""
    monkeypatch.setattr(IV, "LONG", 30)
    facts, dims, f, g = _random_intervals(spark, 60)
    used = []
    bins, lists = IV._by_bins, IV._by_lists
    monkeypatch.setattr(IV, "_by_bins", lambda fact, d, *a: used.append({r._k0 for r in d.select("_k0").distinct().collect()}) or bins(fact, d, *a))
    monkeypatch.setattr(IV, "_by_lists", lambda fact, d, *a: used.append({r._k0 for r in d.select("_k0").distinct().collect()}) or lists(fact, d, *a))
    hits = {i: [p for k2, s, e, p in dims if k is not None and d is not None and k2 == k and s <= d and (e is None or d <= e)] for i, k, d in facts}
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = sorted(((r.i, r.p if how in ("left", "inner") else None) for r in IV.interval_join(
            f, g, ["k"], "d", "s", "e", how=how, dim_cols=["p"], broadcast_bytes=0).collect()), key=str)
        if how in ("left", "inner"):
            want = [(i, p) for i, ps in hits.items() for p in ps or ([None] if how == "left" else [])]
        else:
            want = [(i, None) for i, ps in hits.items() if bool(ps) == (how == "left_semi")]
        assert got == sorted(want, key=str)
    assert used == [{"a", "b"}, {"hot"}] * 4


def test_excluded_days_equal_anti_join(spark, monkeypatch):
    monkeypatch.setattr(IV, "LONG", 30)
    _, dims, _, g = _random_intervals(spark, 60)
    rows = [(i, k, [D(2000, 1, 1) + dt.timedelta(days=37 * i + 11 * j) for j in range(i % 9)]) for i, k in enumerate(["a", "b", "c", "hot", None] * 8)]
    df = spark.createDataFrame(rows, "i long, k string, days array<date>")
    held = lambda k, d: any(k2 == k and s <= d and (e is None or d <= e) for k2, s, e, _ in dims if k is not None)
    want = sorted((i, d) for i, k, ds in rows for d in ds if not held(k, d))
    for limit in (0, 1 << 70):
        assert sorted((r.i, r.d) for r in IV.exclude_days(df, "days", "d", g, ["k"], "s", "e", broadcast_bytes=limit).collect()) == want


def test_large_keys_alone_are_cut(spark):
    """A key with a large share has several buckets, other keys one; the running values equal those of a scan key by key."""
    from quantlake.operators.scan import _large_key_bucket, ordered_scans
    df = spark.range(6000).selectExpr("CASE WHEN id % 3 > 0 THEN -1 WHEN id % 50 = 1 THEN NULL ELSE id END AS k", "cast(id % 7 as int) AS t", "id AS i",
                                      "CASE WHEN id % 5 > 0 THEN id END AS v")
    buckets = {r.k: r.n for r in _large_key_bucket(df, ["k"], ["t", "i"]).groupBy("k").agg(F.count_distinct("_bk").alias("n")).collect()}
    assert buckets[-1] > 1 and sum(n > 1 for n in buckets.values()) <= 2
    aggs = [("v", "last", "l"), ("v", "sum", "s"), ("v", "max", "m"), ("i", "count", "c")]
    for descending in (False, True):
        for inclusive in (False, True):
            a, b = (sorted(map(str, ordered_scans(df, ["k"], ["t", "i"], aggs, inclusive, descending, bucket=how).collect())) for how in ("large", "key"))
            assert a == b
