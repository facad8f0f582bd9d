"""Queries whose stand-ins hold NULL keys, NULL times, NULL values and zero dates.

Roles inside ``events``: views are reports, purchases are observations.
Every 7th event loses its user, every 11th report its time, every 13th report
has the zero date, every 5th event loses its value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.operators import asof as A
from quantlake.operators import panel as PN
from quantlake.operators import promote as P
from quantlake.operators import quality as Q
from quantlake.operators.scan import ordered_scans
from quantlake.plans.catalog import query
from quantlake.plans.tables import DerivedFrame, with_ctes
from quantlake.session import scratch_path

_KEY = "CASE WHEN event_id % 7 <> 0 THEN user_id END"
_VALUE = "CASE WHEN event_id % 5 <> 0 THEN value END"
REPORTS = DerivedFrame("reports", "events", (
    ("k", _KEY), ("rid", "event_id"), ("amount", _VALUE),
    ("known", "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST('1970-01-01 00:00:00' AS TIMESTAMP) "
              "ELSE CAST(ts AS TIMESTAMP) END")), where="event_type = 'view'")
OBSERVED = DerivedFrame("observed", "events", (
    ("k", _KEY), ("oid", "event_id"), ("at", "CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS TIMESTAMP) END")),
    where="event_type = 'purchase'")
PRICES = DerivedFrame("prices", "events", (
    ("k", _KEY), ("eid", "event_id"), ("t", "CAST(ts AS TIMESTAMP)"), ("px", _VALUE),
    ("grp", "CASE WHEN event_type <> 'error' THEN event_type END")))

_ASOF = """
, m AS (SELECT o.oid, r.rid, r.amount, row_number() OVER (PARTITION BY o.oid ORDER BY r.known DESC, r.rid DESC) AS rn
  FROM observed o JOIN reports r ON o.k = r.k AND r.known <= o.at AND r.known <> TIMESTAMP '1970-01-01 00:00:00')
SELECT o.k, o.oid, m.rid, m.amount FROM observed o LEFT JOIN m ON o.oid = m.oid AND m.rn = 1"""


@query("asof_null_keys", ops="J14 J19", sql="WITH " + ", ".join((REPORTS.cte(), OBSERVED.cte())) + _ASOF)
def asof_null_keys(spark, sf):
    left, right = OBSERVED.frame(spark, sf), REPORTS.frame(spark, sf)
    return A.asof_join(left, right, ["k"], "at", "known", ["rid", "amount"], tie_break=["rid"]).select("k", "oid", "rid", "amount")


@query("pit_null_report_date", ops="T9 J14", sql=with_ctes(REPORTS, OBSERVED, body="""
SELECT count(*) AS n, count(rid) AS matched, CAST(sum(CASE WHEN rid % 11 = 0 OR rid % 13 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_used
FROM (SELECT o.oid, (SELECT max_by(r.rid, struct_pack(a := r.known, b := r.rid)) FROM reports r
  WHERE r.k = o.k AND r.known <= o.at AND r.known <> TIMESTAMP '1970-01-01 00:00:00') AS rid FROM observed o)"""))
def pit_null_report_date(spark, sf):
    got = asof_null_keys(spark, sf)
    return got.agg(F.count(F.lit(1)).alias("n"), F.count("rid").alias("matched"),
                   F.sum(F.when((F.col("rid") % 11 == 0) | (F.col("rid") % 13 == 0), 1).otherwise(0)).alias("unknown_used"))


@query("prev_price_with_gaps", ops="W8 W9", sql=with_ctes(PRICES, body="""
SELECT k, eid, px, lag(px) OVER w AS prev_px, CASE WHEN lag(px) OVER w <> 0 THEN px / lag(px) OVER w END - 1 AS ret_px,
  CAST(count(px) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_known
FROM prices WINDOW w AS (PARTITION BY k ORDER BY t, eid)"""))
def prev_price_with_gaps(spark, sf):
    px = PN.lagged(PRICES.frame(spark, sf), ["k"], "t", "px", ["eid"])
    out = ordered_scans(px, ["k"], ["t", "eid"], [(F.col("px"), "count", "n_known")], bucket="day")
    return out.select("k", "eid", "px", "prev_px", "ret_px", "n_known")


@query("histogram_null_group", ops="A14 D14", sql="WITH " + PRICES.cte() + """
, r AS (SELECT grp, min(px) AS lo_, max(px) AS hi_ FROM prices WHERE px IS NOT NULL GROUP BY grp)
SELECT p.grp, least(CAST(floor((px - lo_) / ((hi_ - lo_) / 10.0)) AS INTEGER) + 1, 10) AS bin, count(*) AS n
FROM prices p JOIN r ON p.grp IS NOT DISTINCT FROM r.grp WHERE px IS NOT NULL GROUP BY 1, 2""")
def histogram_null_group(spark, sf):
    return Q.histogram(PRICES.frame(spark, sf), "px", 10, by="grp").select("grp", "bin", "n")


@query("consensus_null_group", ops="A24 A8", sql=with_ctes(PRICES, body="""
SELECT grp, count(px) AS n_est, round(avg(px), 6) AS mean_est, round(stddev_samp(px), 6) AS std_est, max(px) AS high_est,
  min(px) AS low_est, round(median(px), 6) AS median_est FROM prices GROUP BY grp"""))
def consensus_null_group(spark, sf):
    return A.consensus(PRICES.frame(spark, sf), ["grp"], "px")


@query("promote_replay_null_keys", ops="J2 T2 X1", sql=with_ctes(PRICES, body="""
SELECT 'first' AS run, count(*) AS new_rows FROM prices UNION ALL SELECT 'replay', 0"""))
def promote_replay_null_keys(spark, sf):
    """Rows that a chunk with NULL key parts appends when it is promoted, and when it is promoted again."""
    chunk = PRICES.frame(spark, sf)
    path = scratch_path(spark, "null-keys")
    for _ in range(2):
        main = P.read_or_empty(spark, path, chunk.schema)
        new = P.new_rows(chunk, main, ["k", "eid", "grp"])
        new.write.mode("append").parquet(path)
    both = spark.read.parquet(path).select(F.lit(1).alias("kept"), F.lit(0).alias("sent")).unionByName(
        chunk.select(F.lit(0).alias("kept"), F.lit(1).alias("sent")))
    n = both.agg(F.sum("kept").alias("kept"), F.sum("sent").alias("sent"))
    return n.select(F.explode(F.array(F.struct(F.lit("first").alias("run"), F.col("sent").alias("new_rows")),
                                      F.struct(F.lit("replay").alias("run"), (F.col("kept") - F.col("sent")).alias("new_rows")))).alias("r")).select("r.*")
