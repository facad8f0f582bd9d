"""Quirk fixtures through the declared specs: each documented rule, positive and negative."""

import os

from pyspark.sql import functions as F

from conftest import write_text
from quantlake.functions import scalars as S
from quantlake.operators import quality as Q
from quantlake.sources import ingest as I
from quantlake.sources import specs


def _load(spark, tmp, spec, lines, name):
    p = write_text(os.path.join(tmp, name, "f.csv"), "\n".join(lines) + "\n")
    return I.ingest(spark, spec, os.path.dirname(p))


def test_estimate_chunk_quirks(spark, tmp):
    hdr = ("TICKER,CUSIP,OFTIC,CNAME,ACTDATS,ESTIMATOR,ANALYS,CURRFL,PDF,FPI,MEASURE,VALUE,CURR,FPEDATS,"
           "ACTTIMS,REVDATS,REVTIMS,ANNDATS,ANNTIMS,USFIRM,report_curr")
    rows = [
        "AAA,1,A,Co,2020-01-02,000123,000456,,,1,EPS,1.5,USD,2020-12-31,10:00:00,,,2020-01-02,09:00:00,1,USD",
        "AAA,1,A,Co,2020-01-02,000123,000000,,,1,EPS,-99999,USD,2020-12-31,10:00:00,,,2020-01-02,09:00:00,1,USD",
        "AAA,1,A,Co,,,,,,1,EPS,2e12,USD,2020-12-31,10:00:00,,,2020-01-03,09:00:00,1,USD",   # empty NOT NULL date
        "BBB,2,B,Co,2020-02-02,000777,000888,,,1,EPS,,USD,2020-12-31,11:00:00,,,2020-02-02,09:00:00,0,USD",
    ]
    good, rejects, _ = _load(spark, tmp, specs.ESTIMATE_HISTORY, [hdr] + rows, "est")
    assert rejects.count() == 0 and good.count() == 4
    rules = Q.default_null_rules("VALUE", ["ACTDATS", "FPEDATS"], ["ESTIMATOR", "ANALYS"])
    prof = Q.null_profile(good, rules).first()
    assert prof["pct_value_null"] == 0.25 and prof["pct_actdats_zero"] == 0.25 and prof["pct_fpedats_zero"] == 0.0
    assert prof["pct_estimator_missing"] == 0.25 and prof["pct_analys_missing"] == 0.5
    ext = Q.value_extremes(good, "VALUE").first()
    assert (ext["n_neg99999"], ext["n_extreme"]) == (1, 1)
    ts = good.select(S.ts_from_parts("ACTDATS", "ACTTIMS").alias("t")).orderBy("t").first()["t"]
    assert str(ts) == "1970-01-01 10:00:00"


def test_link_end_status(spark, tmp):
    lines = ["gvkey,LINKPRIM,LIID,LINKTYPE,LPERMNO,LINKDT,LINKENDDT",
             "001004,P,01,LC,54594,1972-04-24,E", "001004,P,01,LU,54595,1980-01-01,",
             "001005,C,01,LC,54596,1990-01-01,1999-12-31", "001006,C,01,LC,54597,1990-01-01,someday"]
    good, rejects, _ = _load(spark, tmp, specs.LINK, lines, "link")
    assert rejects.count() == 0
    assert good.where("gvkey = '001004'").count() == 2          # leading zeros kept (string)
    st = {r.status: r.n for r in Q.end_status_counts(good, "LINKENDDT").collect()}
    assert st == {"open": 2, "dated": 1, "invalid": 1}


def test_reserved_return_and_negative_ids(spark, tmp):
    good, _, _ = _load(spark, tmp, specs.SECURITY_PRICES,
                       ["secid,date,open,high,low,close,volume,return,cfadj", "5,2020-01-02,1,2,0.5,1.5,100,0.01,1"],
                       "sp")
    assert good.select(F.col("`return`").alias("ret")).first()["ret"] == 0.01
    lines = ["PERMNO,DlyCalDt,YYYYMMDD,DlyPrc,DlyRet,DlyRetx,DlyVol,ShrOut,DlyCap,DisPERMCO",
             "10001,1925-12-31,19251231,10,0.1,0.1,5,7,70,-5", "10001,2020-01-03,20200102,11,0.1,0.1,5,7,77,9"]
    good, _, _ = _load(spark, tmp, specs.DAILY_STOCK_NEW, lines, "dsf")
    out = good.select("DlyCalDt", S.negative_to_null("DisPERMCO").alias("permco"),
                      (S.yyyymmdd_to_date("YYYYMMDD") == F.col("DlyCalDt")).alias("ymd_ok"),
                      (F.col("DlyPrc") * F.col("ShrOut") == F.col("DlyCap")).alias("cap_ok")).orderBy("DlyCalDt").collect()
    assert str(out[0]["DlyCalDt"]) == "1925-12-31" and out[0]["permco"] is None and out[0]["ymd_ok"]
    assert out[1]["permco"] == 9 and out[1]["ymd_ok"] is False and out[1]["cap_ok"]


def test_old_format_codes(spark, tmp):
    lines = ["PERMNO,date,SICCD,PRC,VOL,RET,RETX,DLRET,DLRETX,CFACPR",
             "1,2020-01-02,Z,10,5,0.0123,0.01,A,S,1", "1,2020-01-03,3571,10,5,B,C,,,1", "1,2020-01-06,3571,10,5,5F,,,,1"]
    good, rejects, _ = _load(spark, tmp, specs.DAILY_STOCK_OLD, lines, "old")
    assert rejects.count() == 0                         # codes live in string columns
    census = {(r.column, r.code): r.n for r in Q.sentinel_census(good, ["SICCD", "RET", "RETX", "DLRET"]).collect()}
    assert census == {("SICCD", "Z"): 1, ("RET", "B"): 1, ("RETX", "C"): 1, ("DLRET", "A"): 1, ("RET", "5F"): 1}
    usable = good.where(~F.col("RET").isin("B", "C", ""))     # P6: NULL also drops
    assert usable.count() == 2


def test_chunk_job_gate_and_idempotent_promote(spark, tmp):
    from quantlake.operators.promote import chunk_job
    hdr = ("TICKER,CUSIP,OFTIC,CNAME,ACTDATS,ESTIMATOR,ANALYS,CURRFL,PDF,FPI,MEASURE,VALUE,CURR,FPEDATS,"
           "ACTTIMS,REVDATS,REVTIMS,ANNDATS,ANNTIMS,USFIRM,report_curr")
    rows = [f"T{i % 3},1,A,Co,2020-01-{1 + i % 28:02d},00012{i % 5},00045{i % 7},,,1,EPS,{i}.5,USD,2020-12-31,"
            f"10:00:00,,,2020-01-{1 + i % 28:02d},09:00:00,1,USD" for i in range(40)]
    csv = write_text(os.path.join(tmp, "chunk", "c.csv"), "\n".join([hdr] + rows) + "\n")
    main = os.path.join(tmp, "main")
    args = dict(date_cols=["ACTDATS", "ANNDATS"], value_col="VALUE", code_cols=["MEASURE", "FPI", "CURR", "TICKER"],
                null_rules=Q.default_null_rules("VALUE", ["ACTDATS"], ["ESTIMATOR", "ANALYS"]),
                thresholds={("staging_qc", "rows"): (">", 0), ("staging_qc", "dup_rows"): ("==", 0)})
    gate, audit = chunk_job(spark, specs.ESTIMATE_HISTORY, os.path.dirname(csv), os.path.join(tmp, "stg"), main, **args)
    assert audit is not None and {r.metric: r.value for r in audit.collect()}["rows_promoted"] == 40
    assert spark.read.parquet(os.path.join(tmp, "stg") + "_table").count() == 0        # staging truncated
    gate, audit = chunk_job(spark, specs.ESTIMATE_HISTORY, os.path.dirname(csv), os.path.join(tmp, "stg"), main, **args)
    assert {r.metric: r.value for r in audit.collect()}["rows_promoted"] == 0       # re-run adds nothing
    assert {(r.check, r.metric): r.value for r in gate.collect()}[("overlap_with_main", "rows_already_in_main")] == 40
    strict = dict(args, thresholds={("staging_qc", "pct_value_null"): ("<", -1)})
    gate, audit = chunk_job(spark, specs.ESTIMATE_HISTORY, os.path.dirname(csv), os.path.join(tmp, "stg"), main, **strict)
    assert audit is None and spark.read.parquet(main).count() == 40                 # failed gate: no promote


def test_catalog_specs_build_schemas():
    for name, s in specs.CATALOG.items():
        assert s.schema.names == s.names and len(set(s.names)) == len(s.names), name
        assert set(s.sort_key) <= set(s.names) and set(s.natural_key) <= set(s.names), name
    assert not specs.OPTION_PRICING.schema["optionid"].nullable


def test_excluded_windows_from_spec(spark, tmp):
    from quantlake.operators import intervals as IV
    lines = ["TICKER,ESTIMATOR,ANALYS,FPI,MEASURE,FPEDATS,ACTDATS,EXCFLA,EXCDATS,EXCENDS",
             "T,001,9,1,EPS,2020-12-31,2020-01-01,1,2020-02-01,2099-12-31",    # far-future end
             "T,002,9,1,EPS,2020-12-31,2020-01-01,1,2020-01-01,2020-01-15",    # ended before
             "T,003,9,1,EPS,2020-12-31,2020-01-01,1,2020-03-01,"]              # missing end = open
    excl, _, _ = _load(spark, tmp, specs.EXCLUDED_ESTIMATES, lines, "excl")
    est = spark.createDataFrame([("T", e, "2020-06-30") for e in ("001", "002", "003", "004")],
                                "TICKER string, ESTIMATOR string, d string").withColumn("d", F.col("d").cast("date"))
    kept = IV.exclude_windows(est, excl, ["TICKER", "ESTIMATOR"], "d", "EXCDATS", "EXCENDS")
    assert sorted(r.ESTIMATOR for r in kept.collect()) == ["002", "004"]


def test_catalog_table_with_comments_and_reserved_names(spark, tmp):
    from quantlake.sources.sinks import ensure_catalog_table
    name = ensure_catalog_table(spark, specs.SECURITY_PRICES, os.path.join(tmp, "sp"),
                                column_comments={"return": "daily total return", "cfadj": "vendor's cumulative factor"})
    assert name == "options_security_prices"
    desc = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["return"] == "daily total return" and desc["cfadj"] == "vendor's cumulative factor"
    spark.createDataFrame([(1, None, None, None, None, None, None, 0.5, None)],
                          spark.table(name).schema).write.insertInto(name)
    ensure_catalog_table(spark, specs.SECURITY_PRICES, os.path.join(tmp, "sp"))     # no-op, keeps the row
    assert spark.table(name).count() == 1
    assert "reserved word" in (spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
                               .where("col_name = 'Comment'").first().data_type)
    spark.sql(f"DROP TABLE {name}")
