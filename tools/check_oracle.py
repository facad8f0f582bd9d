"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares row count, sorted column names and an order-insensitive multiset of
rows (exact, and with floats compared to 1e-9 relative).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quantlake.plans.catalog import load_all  # noqa: E402
from quantlake.plans.tables import TABLES  # noqa: E402
from quantlake.session import get_spark  # noqa: E402


def _norm(v, approx):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if approx:
            return float(f"{v:.9g}")
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows, approx):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
                  "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
                  "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(sdf, res):
    """Columns whose Spark type does not map to the DuckDB result type."""
    duck = {d[0]: str(d[1]).upper() for d in res.description}
    out = []
    for f in sdf.schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        got = duck.get(f.name)
        if got is not None and got != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duck {got}")
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", 8)
    if os.environ.get("CHECK_TZ"):          # run the Spark side under another session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    ok = bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s) [no oracle]")
            ok += 1
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msgs = []
        tm = type_mismatches(sdf, res)
        if tm:
            msgs.append("types " + "; ".join(tm))
        if sorted(scols) != sorted(dcols):
            msgs.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            msgs.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not msgs:
            exact = _rows(scols, srows, False) == _rows(dcols, drows, False)
            close = exact or _rows(scols, srows, True) == _rows(dcols, drows, True)
            if not close:
                a, b = _rows(scols, srows, True), _rows(dcols, drows, True)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msgs.append(f"values differ, e.g. {diff}")
            elif not exact:
                msgs.append("values equal only to 9 digits")
        if msgs and not (len(msgs) == 1 and msgs[0].startswith("values equal only")):
            print(f"FAIL {name} ({ts:.1f}s): " + "; ".join(msgs))
            bad += 1
        else:
            print(f"ok   {name}: {len(srows)} rows ({ts:.1f}s) {'; '.join(msgs)}")
            ok += 1
    print(f"passed {ok}, failed {bad}")


if __name__ == "__main__":
    main()
