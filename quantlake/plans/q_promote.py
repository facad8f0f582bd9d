"""Promote queries (J2, J3, D6–D8, U2, U5, J6, J7) on two overlapping order slices.

Stand-in: staging = orders dated 1998-01-01 or later, main = orders dated
before 1998-07-01; the half year in between is the overlap a re-loaded
chunk would have.  Natural key: customer, priority, status, order date, order key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.operators import promote as P
from quantlake.operators import quality as Q
from quantlake.plans.catalog import query
from quantlake.plans.tables import DerivedFrame, table, with_ctes

_COLS = (
    ("TICKER", "o_custkey"),
    ("MEASURE", "o_orderpriority"),
    ("FPI", "o_orderstatus"),
    ("ACTDATS", "cast(o_orderdate as date)"),
    ("ANNDATS", "date_add(cast(o_orderdate as date), 3)"),
    ("ORDERKEY", "o_orderkey"),
    ("VALUE", "o_totalprice"),
)
STAGING = DerivedFrame("staging", "orders", _COLS, where="o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
MAIN = DerivedFrame("main", "orders", _COLS, where="o_orderdate < TIMESTAMP '1998-07-01 00:00:00'")
KEY = ["TICKER", "MEASURE", "FPI", "ACTDATS", "ORDERKEY"]
_ON = " AND ".join(f"s.{k} = m.{k}" for k in KEY)


def _sm(spark, sf):
    return STAGING.frame(spark, sf), MAIN.frame(spark, sf)


@query("qc_overlap_with_main", ops="D6 J3", sql=with_ctes(STAGING, MAIN, body=f"""
SELECT count(*) AS rows_already_in_main FROM staging s
WHERE EXISTS (SELECT 1 FROM main m WHERE {_ON})"""))
def qc_overlap_with_main(spark, sf):
    s, m = _sm(spark, sf)
    return P.overlap_count(s, m, KEY, prune_on="ACTDATS")


@query("promote_new_rows", ops="J2 U2 T2 S14", sql=with_ctes(STAGING, MAIN, body=f"""
SELECT s.* FROM staging s WHERE NOT EXISTS (SELECT 1 FROM main m WHERE {_ON})"""))
def promote_new_rows(spark, sf):
    s, m = _sm(spark, sf)
    return P.new_rows(s, m, KEY, prune_on="ACTDATS")


@query("promote_prune_ntz", ops="J2 J3 D6 T2", sql="""
WITH staging AS (SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 05:30:00'),
main AS (SELECT event_id, user_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20 21:15:00')
SELECT 'chunk' AS run, (SELECT count(*) FROM staging s WHERE EXISTS (SELECT 1 FROM main m WHERE m.event_id = s.event_id AND m.ts = s.ts)) AS rows_already_in_main,
       (SELECT count(*) FROM staging s WHERE NOT EXISTS (SELECT 1 FROM main m WHERE m.event_id = s.event_id AND m.ts = s.ts)) AS new_rows
UNION ALL
SELECT 'itself', (SELECT count(*) FROM staging), 0""")
def promote_prune_ntz(spark, sf):
    """Overlap and new rows of a chunk whose pruned key is a wall time; any session zone gives the same."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    s = ev.where(F.col("ts") >= F.lit("2024-01-10 05:30:00").cast("timestamp_ntz"))
    m = ev.where(F.col("ts") < F.lit("2024-01-20 21:15:00").cast("timestamp_ntz"))

    def counts(run, main):
        n = P.new_rows(s, main, ["event_id", "ts"], prune_on="ts").agg(F.count(F.lit(1)).alias("n"))
        return P.overlap_count(s, main, ["event_id", "ts"], prune_on="ts").select(F.lit(run).alias("run"), "rows_already_in_main", n.scalar().alias("new_rows"))

    return counts("chunk", m).unionByName(counts("itself", s))


@query("promote_audit", ops="D7 J7 A1 A2", sql=with_ctes(STAGING, MAIN, extra=f"""
new AS (SELECT s.* FROM staging s WHERE NOT EXISTS (SELECT 1 FROM main m WHERE {_ON})),
after AS (SELECT * FROM main UNION ALL SELECT * FROM new)""", body="""
SELECT (SELECT count(*) FROM main) AS main_rows_before,
       (SELECT count(*) FROM staging) AS staging_rows,
       (SELECT count(*) FROM new) AS rows_promoted,
       count(*) AS main_rows_after,
       min(ACTDATS) AS main_min_actdats, max(ACTDATS) AS main_max_actdats,
       min(ANNDATS) AS main_min_anndats, max(ANNDATS) AS main_max_anndats
FROM after"""))
def promote_audit(spark, sf):
    s, m = _sm(spark, sf)
    return P.promote_plan(s, m, KEY, ["ACTDATS", "ANNDATS"])


_GATE = {("row_count_and_range", "rows"): (">", 0.0),
         ("null_profile", "pct_value_null"): ("<=", 0.01),
         ("duplicates", "dup_rows"): ("==", 0.0),
         ("overlap_with_main", "rows_already_in_main"): ("<=", 2000.0)}


@query("promote_gate", ops="D8 D1 D2 D5 D6", sql=with_ctes(STAGING, MAIN, extra=f"""
checks AS (
  SELECT 'row_count_and_range' AS "check", 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM staging
  UNION ALL SELECT 'null_profile', 'pct_value_null',
                   round(count(*) FILTER (WHERE VALUE IS NULL) / count(*), 4) FROM staging
  UNION ALL SELECT 'duplicates', 'dup_rows', CAST(count(*) - count(DISTINCT (TICKER, MEASURE, FPI, ACTDATS, ORDERKEY)) AS DOUBLE)
            FROM staging
  UNION ALL SELECT 'duplicates', 'total_rows', CAST(count(*) AS DOUBLE) FROM staging
  UNION ALL SELECT 'overlap_with_main', 'rows_already_in_main', CAST(count(*) AS DOUBLE)
            FROM staging s WHERE EXISTS (SELECT 1 FROM main m WHERE {_ON}))""", body="""
SELECT "check", metric, value,
  CAST(CASE WHEN "check" = 'row_count_and_range' AND metric = 'rows' THEN 0.0
       WHEN metric = 'pct_value_null' THEN 0.01 WHEN metric = 'dup_rows' THEN 0.0
       WHEN metric = 'rows_already_in_main' THEN 2000.0 END AS DOUBLE) AS "limit",
  CASE WHEN "check" = 'row_count_and_range' AND metric = 'rows' THEN '>'
       WHEN metric = 'pct_value_null' THEN '<=' WHEN metric = 'dup_rows' THEN '=='
       WHEN metric = 'rows_already_in_main' THEN '<=' END AS op,
  CASE WHEN "check" = 'row_count_and_range' AND metric = 'rows' THEN coalesce(value > 0, false)
       WHEN metric = 'pct_value_null' THEN coalesce(value <= 0.01, false)
       WHEN metric = 'dup_rows' THEN coalesce(value = 0, false)
       WHEN metric = 'rows_already_in_main' THEN coalesce(value <= 2000, false)
       ELSE true END AS passed
FROM checks"""))
def promote_gate(spark, sf):
    s, m = _sm(spark, sf)
    checks = (Q.tidy(Q.row_count_and_range(s, [], check=None), "row_count_and_range")
              .unionByName(Q.tidy(Q.null_profile(s, {"pct_value_null": F.col("VALUE").isNull()}, check=None),
                                  "null_profile"))
              .unionByName(Q.tidy(Q.duplicates(s, KEY, check=None), "duplicates"))
              .unionByName(Q.tidy(P.overlap_count(s, m, KEY), "overlap_with_main")))
    return Q.gate(checks, _GATE)


@query("missing_counterpart", ops="J6 U5", sql="""
SELECT 'customer_without_2001_orders' AS side, CAST(c_custkey AS BIGINT) AS key FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= DATE '2001-01-01')
UNION ALL
SELECT 'supplier_without_lines', s_suppkey FROM supplier s
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = s.s_suppkey)
UNION ALL
SELECT 'part_without_lines', p_partkey FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)""")
def missing_counterpart(spark, sf):
    def side(name, dim, dkey, fact, fkey, where=None):
        d = table(spark, sf, dim).select(F.col(dkey).cast("long").alias("key"))
        f = table(spark, sf, fact)
        f = (f.where(where) if where is not None else f).select(F.col(fkey).cast("long").alias("key"))
        return d.join(f, "key", "left_anti").select(F.lit(name).alias("side"), "key")
    return (side("customer_without_2001_orders", "customer", "c_custkey", "orders", "o_custkey",
                 F.col("o_orderdate") >= F.lit("2001-01-01").cast("date"))
            .unionByName(side("supplier_without_lines", "supplier", "s_suppkey", "lineitem", "l_suppkey"))
            .unionByName(side("part_without_lines", "part", "p_partkey", "lineitem", "l_partkey")))
