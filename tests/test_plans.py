"""Plan audit: no registered query plans a Cartesian product or a nested-loop join.

Queries that write while they are built (ingest, export, streams, bucketed
staging) are skipped here; their read-back plans are plain scans.
"""

import contextlib
import io

import pytest

from conftest import SF0001
from quantlake.plans.catalog import load_all

REG = load_all()
WRITES = ("stream_", "csv_", "export_reload", "relayout_write", "vertical_split")


@pytest.mark.parametrize("name", sorted(n for n in REG if not n.startswith(WRITES)))
def test_no_cartesian_or_nested_loop(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        REG[name].fn(spark, SF0001).explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        REG["extract_range"].fn(spark, SF0001).explain()
    plan = buf.getvalue()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def _built_without_jobs(spark, build):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "built")
    try:
        out = build()
        assert not tracker.getJobIdsForGroup("built")
        return out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", ["consensus_panel_full", "split_unadjust", "fundamentals_via_link", "qc_overlap_with_main"])
@pytest.mark.parametrize("small", [True, False])
def test_nothing_runs_while_a_query_is_built(spark, monkeypatch, name, small):
    """Neither for small inputs nor where they count as large (bucketed scans, binned joins)."""
    from quantlake.operators import intervals, scan
    if not small:
        monkeypatch.setattr(scan, "SMALL_BYTES", 0)
        monkeypatch.setattr(intervals, "input_bytes", lambda df: 1 << 60)
    # reading a table's schema is a job of the reader
    for t in ("events", "orders", "lineitem"):
        spark.read.parquet(f"{SF0001}/{t}.parquet")
    read = spark.read.parquet

    def quiet(path):
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", "reader")
        try:
            return read(path)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", "built")

    from quantlake.plans import tables
    monkeypatch.setattr(tables, "table", lambda spark, sf, name: quiet(f"{sf}/{name}.parquet"))
    import importlib
    for m in ("q_temporal", "q_panel", "q_nulls", "q_promote"):
        mod = importlib.import_module(f"quantlake.plans.{m}")
        if hasattr(mod, "table"):
            monkeypatch.setattr(mod, "table", tables.table)
    _built_without_jobs(spark, lambda: REG[name].fn(spark, SF0001))


@pytest.mark.parametrize("name", ["prev_price", "consensus_null_group", "membership_filter", "split_unadjust", "link_join_on_date"])
def test_large_forms_equal_small_ones(spark, monkeypatch, name):
    from quantlake.operators import intervals, scan
    small = sorted(map(tuple, REG[name].fn(spark, SF0001).collect()), key=str)
    monkeypatch.setattr(scan, "SMALL_BYTES", 0)
    monkeypatch.setattr(intervals, "input_bytes", lambda df: 1 << 60)
    large = sorted(map(tuple, REG[name].fn(spark, SF0001).collect()), key=str)
    assert len(small) == len(large) and all(a == pytest.approx(b, nan_ok=True) if any(isinstance(x, float) for x in a) and None not in a else a == b
                                            for a, b in zip(small, large))


def test_scan_reads_rows_and_summary_from_one_exchange(spark):
    from pyspark.sql import functions as F
    from quantlake.operators.scan import ordered_scans
    d = spark.read.parquet(f"{SF0001}/events.parquet")
    out = ordered_scans(d, ["user_id"], ["ts", "event_id"], [(F.col("value"), "last", "l")], False, bucket="range")
    out.collect()
    assert "ReusedExchange" in _plan(out)


def test_staging_qc_multiplies_no_rows(spark):
    assert "Expand" not in _plan(REG["qc_staging_fused"].fn(spark, SF0001))


def test_promote_reads_staging_and_main_once_for_the_join(spark):
    plan = _plan(REG["promote_audit"].fn(spark, SF0001))
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") == 1
