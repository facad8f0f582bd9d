"""Quality jobs: exact median (hot group, ties), histogram, duplicates, keep_one, gate, promote."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from quantlake.operators import promote as P
from quantlake.operators import quality as Q
from quantlake.operators.quantiles import exact_median, exact_percentile


def test_exact_median_hot_group_and_ties(spark):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randrange(50))) for _ in range(5000)]          # heavy ties
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("even", 1.0), ("even", 2.0), ("even", 4.0), ("even", 10.0)]
    rows += [("nulls", None), ("nulls", 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in exact_median(df, "x", "g", "m").collect()}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x in rows if gg == g and x is not None]
        assert got[g] == float(np.median(xs)), g
    p90 = exact_percentile(df.where("g = 'hot'"), "x", None, 0.9, "p").first().p
    assert p90 == float(np.percentile([x for g, x in rows if g == "hot"], 90))


def test_histogram_counts_and_constant(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("c", 5.0)] * 3 + [("a", None)], "g string, x double")
    h = Q.histogram(df, "x", bins=10, by="g")
    assert h.where("g = 'a'").agg(F.sum("n")).first()[0] == 101
    assert h.where("g = 'a' and bin = 10").first().n == 11          # top edge in the last bin
    assert [tuple(r) for r in h.where("g = 'c'").select("bin", "n").collect()] == [(1, 3)]


def test_duplicates_counts_null_key_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    r = Q.duplicates(df, ["a", "b"]).first()
    assert (r.dup_rows, r.total_rows) == (1, 4)


def test_keep_one_deterministic(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (2, 5, "z")], "k int, o int, v string")
    assert sorted(tuple(r) for r in Q.keep_one(df, ["k"], ["o"]).collect()) == [(1, 1, "y"), (2, 5, "z")]


def test_gate(spark):
    checks = spark.createDataFrame([("c", "rows", 10.0), ("c", "dups", 2.0), ("c", "other", None)],
                                   "check string, metric string, value double")
    g = {r.metric: r.passed for r in Q.gate(checks, {("c", "rows"): (">", 0), ("c", "dups"): ("==", 0)}).collect()}
    assert g == {"rows": True, "dups": False, "other": True}


def test_promote_twice_equals_once(spark, tmp):
    main = os.path.join(tmp, "main")
    chunk1 = spark.createDataFrame([(i, f"k{i}", float(i)) for i in range(10)], "id int, k string, v double")
    chunk2 = spark.createDataFrame([(i, f"k{i}", float(i)) for i in range(5, 15)], "id int, k string, v double")
    P.promote(spark, chunk1, main, ["id", "k"], date_cols=[])
    P.promote(spark, chunk2, main, ["id", "k"], date_cols=[])
    audit = {r.metric: r.value for r in P.promote(spark, chunk2, main, ["id", "k"], date_cols=[]).collect()}
    assert audit["rows_promoted"] == 0
    assert spark.read.parquet(main).count() == 15
    assert P.overlap_count(chunk2, spark.read.parquet(main), ["id", "k"]).first()[0] == 10


def test_promote_to_bucketed_table_no_main_exchange(spark, tmp):
    import io
    import contextlib
    chunk = spark.createDataFrame([(i, f"k{i}", float(i)) for i in range(20)], "id int, k string, v double")
    path = os.path.join(tmp, "bucketed")
    P.promote_to_table(spark, chunk, "t_bucketed_main", ["id", "k"], 4, path)
    audit = {r.metric: r.value for r in P.promote_to_table(spark, chunk, "t_bucketed_main", ["id", "k"], 4, path).collect()}
    assert audit["rows_promoted"] == 0 and spark.table("t_bucketed_main").count() == 20
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            P.new_rows(chunk, spark.table("t_bucketed_main"), ["id", "k"], bucketed=True).explain()
        plan = buf.getvalue()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 3   # staging, and both sides of the rows with a NULL part
        assert "EqualTo" not in plan and plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.sql("DROP TABLE t_bucketed_main")


def test_scale_conf():
    from quantlake.session import scale_conf
    c = scale_conf(100 * 2**40, cores=8000)
    assert c["spark.sql.shuffle.partitions"] == "200000"
    assert scale_conf(10 * 2**20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_exact_percentile_refines_hot_group(spark):
    rnd = random.Random(11)
    rows = [("hot", float(rnd.randrange(100000)) / 7.0) for _ in range(6000)]
    rows += [("same", 3.0)] * 700 + [("tiny", 1.0), ("tiny", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    for p in (0.5, 0.37):
        got = {r.g: r.q for r in exact_percentile(df, "x", "g", p, "q", bucket="range").collect()}
        for g in ("hot", "same", "tiny"):
            want = float(np.percentile([x for gg, x in rows if gg == g], p * 100))
            assert abs(got[g] - want) < 1e-9, (g, p)
    one = exact_percentile(df.where("g = 'hot'"), "x", None, 0.5, "q", bucket="range").first().q
    assert abs(one - float(np.median([x for g, x in rows if g == "hot"]))) < 1e-9


def test_staging_qc_approx_close_to_exact(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 20000).select((F.col("id") % 997).cast("string").alias("code"),
                                      (F.col("id") % 5000).alias("k"), F.col("id").cast("double").alias("v"),
                                      F.lit(None).cast("date").alias("d"))
    exact = Q.staging_qc(df, ["d"], {"pct_v_null": F.col("v").isNull()}, "v", ["code"], ["k"]).first()
    approx = Q.staging_qc(df, ["d"], {"pct_v_null": F.col("v").isNull()}, "v", ["code"], ["k"], approx=True).first()
    assert exact.n_code == 997 and exact.dup_rows == 15000
    assert abs(approx.n_code - 997) / 997 < 0.05 and abs(approx.dup_rows - 15000) / 15000 < 0.05


def test_reconcile_rates_count_null_diffs_as_misses(spark):
    import datetime as dt
    from quantlake.operators import reconcile as R
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    a = spark.createDataFrame([("c1", x, 10.0) for x in d], "contract string, date date, a_price double")
    b = spark.createDataFrame([("r1", d[0], 10.001, 10.0), ("r1", d[1], 10.05, 10.2), ("r1", d[2], None, 10.0),
                               ("r1", d[3], 11.0, 11.0), ("r1", d[4], 10.0, None)],
                              "ric string, date date, b_last double, b_settle double")
    mapping = spark.createDataFrame([("c1", "r1")], "contract string, ric string")
    m = R.align(a, b, mapping)
    r = R.reconcile_summary(m).first()
    assert r.n_matched == 5
    assert r.vs_last_exact_pct == 0.4 and r.vs_last_close_pct == 0.6        # NULL diff is a miss, stays in n
    assert r.vs_settle_exact_pct == 0.4 and r.vs_settle_close_pct == 0.4
    assert all(0.0 <= x <= 1.0 for x in (r.vs_last_exact_pct, r.vs_last_close_pct, r.vs_settle_close_pct))
    assert r.vs_last_median_diff == -0.0255 and r.vs_last_max_abs_diff == 1.0  # median of -1, -0.05, -0.001, 0
    out = R.outliers(m, threshold=0.5).collect()
    assert [str(x.date) for x in out] == ["2024-01-04"]


def test_scratch_and_materialize_use_the_checkpoint_folder(spark):
    from quantlake.session import ensure_checkpoint_dir, materialize, scratch_path
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    p = scratch_path(spark, "x")
    assert p.startswith(base) and p != scratch_path(spark, "x")            # fresh folder each time
    m = materialize(spark.range(10), "m")
    strip = lambda u: u.replace("file://", "").replace("file:", "")
    assert m.count() == 10 and strip(m.inputFiles()[0]).startswith(strip(base))


def test_percentile_of_bins_takes_few_values_on(spark, monkeypatch):
    """Large groups send only the values of the bins with their ranks on; values of both signs, zero, infinities and NaN."""
    from quantlake.operators import quantiles as QT
    import numpy as np
    monkeypatch.setattr(QT, "MANY", 100)
    rng = np.random.default_rng(3)
    xs = {"wide": np.exp(rng.normal(size=800) * 9) * rng.choice([-1, 1], 800), "ties": rng.integers(-2, 3, 500).astype(float),
          "narrow": 1 + rng.random(400) * 1e-6, "few": rng.random(7), "inf": np.array([-np.inf] * 60 + [np.inf] * 61)}
    rows = [(g, float(x)) for g, v in xs.items() for x in v] + [("wide", None), ("wide", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for p in (0.0, 0.3, 0.5, 0.77, 1.0):
        got = {r.g: r.q for r in exact_percentile(df, "x", "g", p, "q", bucket="large").collect()}
        assert set(got) == set(xs)
        for g, v in xs.items():
            v = np.sort(v)
            pos = (len(v) - 1) * p
            lo, hi = v[int(np.floor(pos))], v[int(np.ceil(pos))]
            want = lo if pos == np.floor(pos) else lo + (hi - lo) * (pos - np.floor(pos))
            assert got[g] == want or abs(got[g] - want) <= 1e-9 * abs(want) or (np.isnan(want) and np.isnan(got[g]))
    x = df.where("g = 'wide' AND x IS NOT NULL AND NOT isnan(x)").selectExpr("struct(g AS g0) AS _g", "x AS _x")
    lo, hi = QT._picked_bins(x, 0.5)[1].select("_bin_lo", "_bin_hi").first()
    assert x.where(QT._bin(F.col("_x")).isin(lo, hi)).count() < 40


def test_staging_qc_of_large_input_deals_keys_out(spark, tmp, monkeypatch):
    """The number of parts that the keys are grouped in follows the input, not the session; the figures are the same."""
    path = os.path.join(tmp, "chunk")
    spark.range(3000).selectExpr("id % 700 AS k", "cast(id % 5 as string) AS code", "date_add(date'2020-01-01', cast(id % 90 as int)) AS d",
                                 "CASE WHEN id % 11 > 0 THEN cast(id as double) END AS v").write.parquet(path)
    df = spark.read.parquet(path)
    qc = lambda: Q.staging_qc(df, ["d"], {"pct_v_null": F.col("v").isNull()}, "v", ["code"], ["k", "code"])
    small = qc().first()
    monkeypatch.setattr(Q, "KEYS_APART", 0)
    monkeypatch.setattr(Q, "KEY_PART", -(-Q.input_bytes(df) // 37))
    large = qc()
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert large.first() == small and ", 37), REPARTITION_BY_NUM" in plan
