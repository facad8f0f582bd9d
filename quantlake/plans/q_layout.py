"""Re-layout and export queries.

Stand-in: ``lineitem`` plays the wide option-price table with key
(l_orderkey, l_linenumber) = (optionid, date); ``orders`` plays a dated
table to export or extract by range.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quantlake.functions.scalars import year_range
from quantlake.operators import layout as L
from quantlake.operators.quality import keep_one
from quantlake.plans.catalog import query
from quantlake.plans.tables import table
from quantlake.session import scratch_path
from quantlake.sources import sinks

KEY = ["l_orderkey", "l_linenumber"]
GROUPS = {"prices": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
          "flags": ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]}
_ORDER = GROUPS["flags"] + GROUPS["prices"]


@query("vertical_split_rejoin", ops="J1 P1 P5 T3 W1", sql=f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_partkey, l_suppkey,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_ORDER)}) AS rn
      FROM lineitem WHERE l_shipdate >= DATE '2000-01-01' AND l_shipdate < DATE '2001-01-01')
WHERE rn = 1""")
def vertical_split_rejoin(spark, sf):
    li = table(spark, sf, "lineitem").where(year_range("l_shipdate", 2000))
    clean = keep_one(li, KEY, _ORDER)
    # stage the cleaned year once, bucketed by the key: every column group read
    # from it keeps the bucket layout, so the rejoin needs no exchange
    name = "vsplit_" + uuid.uuid4().hex[:12]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sinks.write_bucketed(clean, name, KEY, n, scratch_path(spark, name))
    parts = L.vertical_split(spark.table(name), KEY, GROUPS)
    return L.vertical_join(parts, KEY).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("relayout_audit", ops="D17 J1 B9", sql="""
WITH b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows_before FROM lineitem GROUP BY 1),
a AS (SELECT CAST(year(f.l_shipdate) AS INTEGER) AS year, count(*) AS rows_after
      FROM lineitem p JOIN lineitem f USING (l_orderkey, l_linenumber) GROUP BY 1)
SELECT coalesce(b.year, a.year) AS year, coalesce(rows_before, 0) AS rows_before,
       coalesce(rows_after, 0) AS rows_after, coalesce(rows_after, 0) - coalesce(rows_before, 0) AS diff
FROM b FULL OUTER JOIN a ON a.year = b.year""")
def relayout_audit(spark, sf):
    return L.rejoin_audit(table(spark, sf, "lineitem"), KEY, "l_shipdate")


@query("relayout_write", ops="T3 S20 P15 S14", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
       l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem""")
def relayout_write(spark, sf):
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "relayout")
    # l_discount / l_tax play the derivable columns that the rewrite drops
    L.relayout(li, path, sort=["l_partkey", "l_shipdate", "l_orderkey"], drop=["l_discount", "l_tax"],
               year_col="l_shipdate")
    back = sinks.reload(spark, path)
    return back.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate"),
                       F.col("year").cast("int").alias("year"))


@query("export_reload_range", ops="T4 S15 S16 S18 P4 F9", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""")
def export_reload_range(spark, sf):
    o = table(spark, sf, "orders")
    back = sinks.export_range(o, "o_orderdate", "1996-01-01", "1996-06-30", scratch_path(spark, "export"),
                              "orders", columns=["o_orderkey", "o_orderdate", "o_totalprice"],
                              sort=["o_orderkey"])
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("export_dry_run", ops="S17 A1", sql="""
SELECT count(*) AS rows FROM orders WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""")
def export_dry_run(spark, sf):
    return sinks.export_range(table(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1996-06-30",
                              "unused", "orders", dry_run=True)


@query("extract_range", ops="T5 S19 P4 F7", sql="""
SELECT CAST(o_orderdate AS DATE) AS date, o_custkey, o_totalprice FROM orders
WHERE o_orderdate BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'""")
def extract_range(spark, sf):
    out = sinks.extract_range(table(spark, sf, "orders"), ["o_orderdate", "o_custkey", "o_totalprice"],
                              "o_orderdate", "1997-03-01", "1998-02-28")
    return out.select(F.col("o_orderdate").cast("date").alias("date"), "o_custkey", "o_totalprice")
