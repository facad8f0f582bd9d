"""Streaming queries (X1–X5) run over ``events`` written as file chunks.

``events`` is written to a source folder as three chunks that overlap by
half a day of event time (a re-delivered tail, as with overlapping vendor
extracts).  Each query drives a stream with ``availableNow`` to completion
and returns the sink table; the oracle is the batch equivalent.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.plans.catalog import query
from quantlake.plans.tables import table
from quantlake.session import scratch_path
from quantlake.streaming import stream as X

_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
_OVERLAP_HOURS = 12


def write_chunks(spark, sf, overlap: bool = True):
    """Write events as time chunks into one folder (later chunks written later)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    path = scratch_path(spark, "chunks")
    lo = None
    bounds = list(_CUTS) + [None]
    for hi in bounds:
        c = ev
        if lo is not None:
            start = F.lit(lo).cast("timestamp_ntz")
            if overlap:
                start = start - F.expr(f"interval {_OVERLAP_HOURS} hours")
            c = c.where(F.col("ts") >= start)
        if hi is not None:
            c = c.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        c.write.mode("append").parquet(path)
        lo = hi
    return path, ev.schema


_BATCH = """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events"""


def _out(df):
    return df.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day"))


@query("stream_promote", ops="X1 X4 T2 J2", sql=_BATCH)
def stream_promote(spark, sf):
    src, schema = write_chunks(spark, sf)
    main = scratch_path(spark, "stream-main")
    q = X.stream_promote(X.file_stream(spark, src, schema, max_files=4), main, ["event_id"],
                         scratch_path(spark, "ckpt"), qc_path=scratch_path(spark, "qc"), date_cols=["ts"],
                         prune_on="event_id")
    q.awaitTermination()
    return _out(spark.read.parquet(main))


@query("stream_promote_ledger", ops="X1 D1 D2 D3 D4 D5 D6 D8", sql="""
SELECT 'first' AS run, count(*) AS rows_staged, 0::BIGINT AS rows_already_in_main, count(*) AS rows_promoted, count(*) AS main_rows,
       count(*) FILTER (WHERE value IS NULL) AS null_values, count(DISTINCT event_type) AS n_event_type,
       min(value) AS minv, max(value) AS maxv, 0::BIGINT AS dup_rows FROM events
UNION ALL
SELECT 'again', count(*), count(*), 0, count(*), count(*) FILTER (WHERE value IS NULL), count(DISTINCT event_type),
       min(value), max(value), 0 FROM events""")
def stream_promote_ledger(spark, sf):
    """Ledger and QC rows of one batch with all events, promoted, and of the same rows under a second checkpoint."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    src, main = scratch_path(spark, "chunk"), scratch_path(spark, "stream-main")
    ev.write.parquet(src)
    runs = []
    for run in ("first", "again"):
        ckpt, qc = scratch_path(spark, "ckpt"), scratch_path(spark, "qc")
        X.stream_promote(X.file_stream(spark, src, ev.schema), main, ["event_id", "ts"], ckpt, qc, ["ts"], prune_on="ts",
                         null_rules={"null_values": F.col("value").isNull()}, value_col="value", code_cols=["event_type"],
                         thresholds={("batch", "rows"): (">", 0.0)}).awaitTermination()
        led, q = spark.read.parquet(X.ledger_path(ckpt)), spark.read.parquet(qc)
        n = spark.read.parquet(main).agg(F.count(F.lit(1)).alias("main_rows"))
        # the share of NULLs, rounded to four digits, times the rows
        runs.append(led.join(q.drop("rows_already_in_main"), "batch_id").withColumn("main_rows", n.scalar()).select(
            F.lit(run).alias("run"), "rows_staged", "rows_already_in_main", "rows_promoted", "main_rows",
            F.round(F.col("null_values") * F.col("rows")).cast("long").alias("null_values"), "n_event_type", "minv", "maxv", "dup_rows"))
        runs[-1] = spark.createDataFrame(runs[-1].collect(), runs[-1].schema)      # one row, before main changes again
    return runs[0].unionByName(runs[1])


@query("stream_dedupe", ops="X2 X4", sql=_BATCH)
def stream_dedupe(spark, sf):
    src, schema = write_chunks(spark, sf)
    sink = scratch_path(spark, "dedupe")
    d = X.stream_dedupe(X.file_stream(spark, src, schema, max_files=4), ["event_id"], "ts", "1 day")
    X.to_parquet(d, sink, scratch_path(spark, "ckpt")).awaitTermination()
    return _out(spark.read.parquet(sink))


@query("stream_window_qc", ops="X3 D1 D2 D3", sql="""
WITH w AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, ts, value FROM events)
SELECT CAST(window_start AS DATE) AS day, count(*) AS rows, round(count(*) FILTER (WHERE value IS NULL) / count(*), 4) AS pct_null,
       min(value) AS minv, max(value) AS maxv
FROM w GROUP BY window_start""")
def stream_window_qc(spark, sf):
    src, schema = write_chunks(spark, sf, overlap=False)
    sink, checkpoint = scratch_path(spark, "qc"), scratch_path(spark, "ckpt")
    control = X.open_control(spark, scratch_path(spark, "control"))
    for run in ("input", "seal"):
        if run == "seal":
            X.seal(spark, control)
        agg = X.stream_qc(X.file_stream(spark, src, schema, max_files=4), "ts", "1 day", "1 hour", "value", control=control)
        X.to_parquet(agg, sink, checkpoint).awaitTermination()
    out = spark.read.parquet(sink)
    return out.select(F.col("window_start").cast("date").alias("day"), "rows", "pct_null", "minv", "maxv")


@query("stream_link", ops="X5 J10 W6", sql="""
WITH s AS (SELECT user_id, event_id AS signup_id, CAST(ts AS DATE) AS valid_from,
                  CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS DATE) - 1 AS valid_to
           FROM events WHERE event_type = 'signup')
SELECT e.event_id, s.signup_id FROM events e
LEFT JOIN s ON s.user_id = e.user_id AND CAST(e.ts AS DATE) >= s.valid_from
           AND CAST(e.ts AS DATE) <= coalesce(s.valid_to, DATE '9999-12-31')
WHERE e.event_type = 'click'""")
def stream_link(spark, sf):
    from quantlake.operators.asof import valid_to_next
    src, schema = write_chunks(spark, sf, overlap=False)
    ev = table(spark, sf, "events")
    signups = ev.where(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("signup_id"), "ts")
    link = valid_to_next(signups, ["user_id"], "ts", ["signup_id"]).select(
        "user_id", "signup_id", F.col("ts").cast("date").alias("valid_from"), "valid_to")
    clicks = X.file_stream(spark, src, schema).where(F.col("event_type") == "click") \
        .withColumn("d", F.col("ts").cast("date"))
    j = X.stream_link(clicks, link, ["user_id"], "d", "valid_from", "valid_to", dim_cols=["signup_id"])
    sink = scratch_path(spark, "link")
    X.to_parquet(j.select("event_id", "signup_id"), sink, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(sink)
