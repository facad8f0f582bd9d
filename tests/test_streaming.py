"""Streaming promote over overlapping chunks equals the batch promote; dedupe and window QC run."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from quantlake.operators import promote as P
from quantlake.plans import q_stream
from quantlake.plans.tables import table
from quantlake.streaming import stream as X


def test_stream_promote_equals_batch(spark, tmp):
    src, schema = q_stream.write_chunks(spark, SF0001)
    main = os.path.join(tmp, "main")
    q = X.stream_promote(X.file_stream(spark, src, schema, max_files=2), main, ["event_id"],
                         os.path.join(tmp, "ckpt"), qc_path=os.path.join(tmp, "qc"), date_cols=["ts"])
    q.awaitTermination()
    streamed = spark.read.parquet(main)
    batch_main = os.path.join(tmp, "batch")
    P.promote(spark, spark.read.parquet(src), batch_main, ["event_id"], date_cols=[], dedupe_within=True)
    batch = spark.read.parquet(batch_main)
    assert streamed.count() == batch.count() == table(spark, SF0001, "events").count()
    assert streamed.exceptAll(batch).count() == 0
    assert spark.read.parquet(os.path.join(tmp, "qc")).agg(F.sum("rows")).first()[0] > streamed.count()
    # replaying the stream from a fresh checkpoint adds nothing
    X.stream_promote(X.file_stream(spark, src, schema), main, ["event_id"], os.path.join(tmp, "ckpt2")).awaitTermination()
    assert spark.read.parquet(main).count() == streamed.count()


def test_stream_windows_independent_of_session_zone(spark):
    import duckdb
    from quantlake.plans.catalog import load_all
    q = load_all()["stream_window_qc"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF0001}/events.parquet')")
    want = sorted(con.execute(q.sql).fetchall())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = sorted(tuple(r) for r in q.fn(spark, SF0001).collect())
            assert got == want, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _table_files(path):
    return {f: os.path.getmtime(os.path.join(path, f)) for f in os.listdir(path)}


def test_replayed_batch_is_a_no_op(spark, tmp):
    """The commit of a batch is lost: it runs again, finds itself in the ledger and touches nothing; main need not even be readable."""
    src, main, ckpt, qc = (os.path.join(tmp, n) for n in ("src", "main", "ckpt", "qc"))
    rows = spark.createDataFrame([(i, f"t{i % 3}", float(i) if i % 4 else None) for i in range(20)] + [(3, "t0", 3.0)], "id long, t string, v double")
    rows.coalesce(1).write.parquet(src)

    def run(**more):
        X.stream_promote(X.file_stream(spark, src, rows.schema), main, ["id"], ckpt, qc, order=["t", "v"], value_col="v", code_cols=["t"],
                         null_rules={"no_v": F.col("v").isNull()}, **more).awaitTermination()

    run()
    assert spark.read.parquet(main).count() == 20
    entry = spark.read.parquet(X.ledger_path(ckpt)).first()
    assert (entry.rows_staged, entry.rows_already_in_main, entry.rows_promoted, entry.passed) == (21, 0, 20, True)
    q = spark.read.parquet(qc).first()
    assert (q.rows, q.n_t, q.dup_rows, q.minv, q.maxv, q.rows_already_in_main) == (21, 3, 1, 1.0, 19.0, 0) and q.no_v == round(5 / 21, 4)
    before = _table_files(main)
    for name in ("0", ".0.crc"):
        f = os.path.join(ckpt, "commits", name)
        if os.path.exists(f):
            os.unlink(f)
    run()
    assert _table_files(main) == before


def test_batch_that_breaks_the_gate_is_not_promoted(spark, tmp):
    src, main, ckpt, qc = (os.path.join(tmp, n) for n in ("src", "main", "ckpt", "qc"))
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "id long, t string")
    rows.write.parquet(src)
    X.stream_promote(X.file_stream(spark, src, rows.schema), main, ["id"], ckpt, qc, thresholds={("batch", "rows"): (">", 5.0)}).awaitTermination()
    assert not os.path.exists(main)
    entry = spark.read.parquet(X.ledger_path(ckpt)).first()
    assert (entry.rows_staged, entry.rows_promoted, entry.passed) == (2, 0, False)


def test_promote_bounds_do_not_pass_through_the_zone(spark):
    rows = spark.sql("SELECT id, timestamp_ntz'2024-03-10 02:30:00' + make_dt_interval(0, id) AS t FROM range(5)")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert P.new_rows(rows, rows, ["id", "t"], prune_on="t").count() == 0, tz
            assert P.overlap_count(rows, rows, ["id", "t"], prune_on="t").first()[0] == 5, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
