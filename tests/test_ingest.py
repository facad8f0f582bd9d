"""Ingest quirks: by-name mapping, width errors, strict numbers, empty cells, budget, header check."""

import os

import pytest

from conftest import write_text
from quantlake.sources import ingest as I
from quantlake.sources.specs import spec

SPEC = spec("t.daily", "PERMNO:long! date:date! RET PRC:double VOL:long", budget_rows=1, budget_ratio=0.1)


def _csv(tmp, body, name="a.csv"):
    return write_text(os.path.join(tmp, "in", name), body)


def test_by_name_and_quirks(spark, tmp):
    path = _csv(tmp, "\n".join([
        "PRC,RET,date,PERMNO,VOL",          # header in another order than the spec
        "10.5,0.0123,2020-01-02,1,100",
        "11.0,B,20200103,1,",               # code in RET, yyyyMMdd date, empty VOL -> NULL
        "5F,C,1/6/2020,2,7",                # 5F must not parse as 5.0
        "12.0,,2020-01-07,2,8,extra",       # one field too many
        "13.0,0.1,2020-01-08",              # too few
        "14.0,0.2,notadate,3,9",            # bad date
        ",0.3,2020-01-09,3,1",              # empty price -> NULL (nullable)
    ]) + "\n")
    good, rejects, report = I.ingest(spark, SPEC, os.path.dirname(path))
    g = {r["PERMNO"]: r for r in good.orderBy("date").collect()}
    rows = good.orderBy("date").collect()
    assert [r["RET"] for r in rows] == ["0.0123", "B", "0.3"]
    assert rows[1]["VOL"] is None and str(rows[1]["date"]) == "2020-01-03"
    assert rows[2]["PRC"] is None
    reasons = sorted(r["reason"] for r in rejects.collect())
    assert reasons == ["PRC", "date", "width", "width"]
    rep = report.first()
    assert (rep["rows_read"], rep["rows_good"], rep["rows_rejected"]) == (7, 3, 4)
    assert rep["within_budget"] is False      # 4 > 1 rows and 4/7 > 0.1
    assert g  # by-name mapping kept PERMNO numeric


def test_budget_passes_when_only_one_limit_exceeded(spark, tmp):
    s = spec("t.x", "a:long b:double", budget_rows=1, budget_ratio=0.5)
    path = _csv(tmp, "a,b\n1,1.0\n2,x\n3,y\n4,4\n5,5\n6,6\n")
    _, _, report = I.ingest(spark, s, os.path.dirname(path))
    r = report.first()
    assert r["rows_rejected"] == 2 and r["within_budget"] is True   # 2 > 1 row but 2/6 < 0.5


def test_load_raises_over_budget_and_keeps_table(spark, tmp):
    s = spec("t.x", "a:long b:double", budget_rows=0, budget_ratio=0.0)
    path = _csv(tmp, "a,b\n1,1.0\n2,x\n")
    table = os.path.join(tmp, "table")
    spark.createDataFrame([(9, 9.0)], "a long, b double").write.parquet(table)
    with pytest.raises(I.BudgetExceeded):
        I.load(spark, s, os.path.dirname(path), table, os.path.join(tmp, "stage"))
    assert spark.read.parquet(table).count() == 1   # never dropped on failure


def test_not_null_defaults(spark, tmp):
    s = spec("t.x", "k:string! d:date! n:long!")
    path = _csv(tmp, "k,d,n\n,,\n")
    good, _, _ = I.ingest(spark, s, os.path.dirname(path))
    r = good.first()
    assert (r["k"], str(r["d"]), r["n"]) == ("", "1970-01-01", 0)


def test_header_check_and_sniff(spark, tmp):
    path = _csv(tmp, "permno\tdate\tRET\tEXTRA\n1\t2020-01-01\t0.1\tz\n", name="t.tsv")
    assert I.sniff_delimiter(I.header_line(spark, path)) == "\t"
    hc = {r["column"]: r["status"] for r in I.header_check(spark, SPEC, path).collect()}
    assert hc["PERMNO"] == "missing" and hc["permno"] == "case" and hc["EXTRA"] == "extra"
    assert hc["date"] == "ok" and hc["PRC"] == "missing"


def test_files_by_size(spark, tmp):
    from quantlake.sources.sinks import files_by_size
    _csv(tmp, "a\n1\n", name="small.csv")
    _csv(tmp, "a\n" + "1\n" * 100, name="big.csv")
    rows = files_by_size(spark, os.path.join(tmp, "in"), "*.csv").collect()
    assert rows[0]["path"].endswith("big.csv") and rows[0]["length"] > rows[1]["length"]


def test_load_chunks_largest_first_with_budgets(spark, tmp):
    s = spec("t.x", "a:long b:double", budget_rows=1, budget_ratio=0.2)
    _csv(tmp, "a,b\n" + "".join(f"{i},{i}.5\n" for i in range(50)), name="big.csv")
    _csv(tmp, "a,b\n1,x\n2,y\n3,3\n", name="bad.csv")
    _csv(tmp, "b,a\n9.5,9\n", name="small.csv")           # other column order
    table = os.path.join(tmp, "table")
    rep = I.load_chunks(spark, s, os.path.join(tmp, "in"), table, on_error="skip").collect()
    assert [(r["file"].rsplit("/", 1)[1], r["status"]) for r in rep] == \
        [("big.csv", "loaded"), ("bad.csv", "over_budget"), ("small.csv", "loaded")]
    by_file = {r["file"].rsplit("/", 1)[1]: r for r in rep}
    assert by_file["big.csv"]["rows_written"] == 50 and by_file["small.csv"]["rows_written"] == 1
    assert by_file["bad.csv"]["status"] == "over_budget"
    assert spark.read.parquet(table).count() == 51


def test_table_management_sinks(spark, tmp):
    import pyarrow.parquet as pq
    from quantlake.sources import sinks
    sinks.ensure_schema(spark, "ql_test_schema")
    assert spark.catalog.databaseExists("ql_test_schema")
    path = os.path.join(tmp, "t")
    schema = spark.createDataFrame([(1, "x")], "a long, b string").schema
    sinks.ensure_table(spark, path, schema)
    spark.createDataFrame([(1, "x")], schema).write.mode("append").parquet(path)
    assert sinks.ensure_table(spark, path, schema).count() == 1           # existing data is kept
    assert sinks.clone_schema(spark.read.parquet(path)) == schema
    big = spark.range(0, 2500).selectExpr("id", "date_add(date'2020-01-01', cast(id % 100 as int)) as d")
    out = sinks.write_clustered(big.coalesce(1), os.path.join(tmp, "c"), ["id"], partitions=1, row_group_rows=1000)
    files = [f for f in os.listdir(out) if f.endswith(".parquet")]
    md = pq.ParquetFile(os.path.join(out, files[0])).metadata
    assert [md.row_group(i).num_rows for i in range(md.num_row_groups)] == [1000, 1000, 500]
    assert md.row_group(0).column(0).compression == "ZSTD"


def test_date_predicates_cover_range_without_overlap():
    from quantlake.sources.sinks import date_predicates
    p = date_predicates("date", "2000-01-01", "2000-03-15", step_days=31)
    assert p == ["date >= DATE '2000-01-01' AND date <= DATE '2000-01-31'",
                 "date >= DATE '2000-02-01' AND date <= DATE '2000-03-02'",
                 "date >= DATE '2000-03-03' AND date <= DATE '2000-03-15'"]


MS = spec("t.m", "a:long! b:double", budget_rows=0, budget_ratio=0.0)


def _both(spark, tmp):
    from quantlake.sources import manifest as M
    rows = sorted((r.a, r.b) for r in M.loaded(spark, MS, os.path.join(tmp, "t"), os.path.join(tmp, "m")).collect())
    plain = sorted((r.a, r.b) for r in spark.read.parquet(os.path.join(tmp, "t")).collect())
    return rows, plain


@pytest.mark.parametrize("where", ["commit", "_sweep", "history", "current"])
def test_killed_load_run_again_gives_the_same_table(spark, tmp, monkeypatch, where):
    from quantlake.sources import manifest as M
    _csv(tmp, "a,b\n1,1.5\n2,2.5\n", name="one.csv")
    _csv(tmp, "b,a\n3.5,3\n", name="two 1999-01 to 1999-12.csv")        # other column order, blanks in the name
    args = (spark, MS, os.path.join(tmp, "in"), os.path.join(tmp, "t"), os.path.join(tmp, "m"))
    if where != "current":
        with monkeypatch.context() as m:
            m.setattr(M, where, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError, match="killed"):
                M.load_once(*args)
    M.load_once(*args)
    want = [(1, 1.5), (2, 2.5), (3, 3.5)]
    assert _both(spark, tmp) == (want, want)
    assert {r.status for r in M.load_once(*args).collect()} == {"present"}
    assert _both(spark, tmp) == (want, want)
    # a file that comes again with other content replaces its rows
    _csv(tmp, "a,b\n1,1.5\n7,7.5\n", name="one.csv")
    status = {r.file.rsplit("/", 1)[1][:3]: r.status for r in M.load_once(*args).collect()}
    assert status == {"one": "loaded", "two": "present"}
    want = [(1, 1.5), (3, 3.5), (7, 7.5)]
    assert _both(spark, tmp) == (want, want)


def test_load_once_budget_by_file_and_missing_ranges(spark, tmp):
    from quantlake.sources import manifest as M
    from quantlake.sources import sinks
    _csv(tmp, "a,b\n1,1.5\n", name="1999-01 to 1999-12.csv")
    _csv(tmp, "a,b\n2,x\n", name="2000-01 to 2000-12.csv")
    args = (spark, MS, os.path.join(tmp, "in"), os.path.join(tmp, "t"), os.path.join(tmp, "m"))
    with pytest.raises(I.BudgetExceeded):
        M.load_once(*args)
    assert not os.path.exists(args[3])
    assert sorted(r.status for r in M.load_once(*args, on_error="skip").collect()) == ["loaded", "over_budget"]
    ranges = sinks.expand_ranges(spark, [1999, 2000])
    assert [str(r.start) for r in M.missing_ranges(ranges, M.current(spark, args[4])).collect()] == ["2000-01-01"]


def test_lazy_ingest_reads_mixed_headers_and_checks_them(spark, tmp):
    _csv(tmp, "a,b\n1,1.5\n", name="x.csv")
    _csv(tmp, "b\ta\n2.5\t2\n", name="y.csv")
    good, rejects, report = I.ingest(spark, MS, os.path.join(tmp, "in"))
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, 1.5), (2, 2.5)] and rejects.count() == 0 and report.first().rows_read == 2
    _csv(tmp, "a,B\n3,3.5\n", name="z.csv")
    with pytest.raises(I.HeaderMismatch):
        I.ingest(spark, MS, os.path.join(tmp, "in"))
