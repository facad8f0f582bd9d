"""Every registered query vs its DuckDB oracle on sf0.001 (rows-only when no oracle)."""

import duckdb
import pytest

from conftest import SF0001
from quantlake.plans.catalog import load_all
from quantlake.plans.tables import TABLES
from tools.check_oracle import _rows, type_mismatches

REG = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    q = REG[name]
    df = q.fn(spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    if q.sql is None:
        assert isinstance(rows, list)
        return
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert type_mismatches(df, res) == []
    assert len(rows) == len(drows)
    assert _rows(df.columns, rows, True) == _rows(dcols, drows, True)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1
    assert set(E.oracle_sql()) <= set(E.queries())
