"""Shared folder: required off local, scratch tables removable; scans with NULL keys at every grain."""

import os
from types import SimpleNamespace

import pytest

from quantlake.operators.scan import ordered_scans
from quantlake.session import clear_scratch, ensure_checkpoint_dir, materialize


def test_no_shared_folder_off_local():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_clear_scratch(spark):
    clear_scratch(spark)
    df = materialize(spark.range(3), "gone-later")
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert df.count() == 3 and os.path.exists(path)
    assert clear_scratch(spark) == 1 and not os.path.exists(path)


def test_every_grain_gives_the_same_rows_with_null_keys_and_times(spark):
    rows = [(None if i % 5 == 0 else i % 3, None if i % 11 == 0 else f"2020-0{1 + i % 3}-{1 + i % 27:02d} 0{i % 9}:{i % 60:02d}:00", i, None if i % 4 == 0 else float(i))
            for i in range(120)]
    df = spark.createDataFrame(rows, "k int, t string, i int, v double").selectExpr("k", "CAST(t AS TIMESTAMP_NTZ) AS t", "i", "v")
    out = []
    for bucket in ("month", "day", "hour", "minute", "auto"):
        got = ordered_scans(df, ["k"], ["t", "i"], [("v", "last", "prev"), ("v", "sum", "total"), ("i", "count", "n")], inclusive=False, bucket=bucket)
        out.append(sorted(map(str, got.select("i", "prev", "total", "n").collect())))
    assert all(x == out[0] for x in out)
    by_key = {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2])):
        seen = by_key.setdefault(k, [])
        want = next((x for x in reversed(seen) if x is not None), None)
        row = next(r for r in out[0] if r.startswith(f"Row(i={i},"))
        assert f"prev={want}," in row
        seen.append(v)
