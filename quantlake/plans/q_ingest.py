"""Ingest queries (T1, S1–S9, S21, S22) over ``orders`` rendered as a vendor CSV.

The extract is written from ``orders`` into the shared scratch folder with
the columns in a different order than the spec, three date layouts, and
rows broken on purpose (chosen by customer key): one field too many or too
few, an unparseable number (``12.3.4``, ``5F``), an unparseable date, and an
empty price (a valid NULL).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.plans.catalog import query
from quantlake.plans.tables import table
from quantlake.session import scratch_path
from quantlake.sources import ingest as I
from quantlake.sources import manifest as M
from quantlake.sources import sinks
from quantlake.sources.specs import spec

ORDERS_SPEC = spec("vendor.orders",
                   "o_orderkey:long! o_custkey:long! o_orderstatus o_totalprice:double "
                   "o_orderdate:date! o_orderpriority",
                   natural_key=("o_orderkey",), budget_rows=100, budget_ratio=0.001)
HEADER_ORDER = ["o_totalprice", "o_orderdate", "o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"]

_WIDE = "o_custkey = 7 AND o_orderstatus = 'F'"
_SHORT = "o_custkey = 11 AND o_orderstatus = 'O'"
_RENDER = {
    "o_totalprice": "case when o_custkey = 13 then '12.3.4' when o_custkey = 23 then '5F' "
                    "when o_custkey = 19 then '' else cast(o_totalprice as string) end",
    "o_orderdate": "case when o_custkey = 17 then 'notadate' "
                   "when o_orderpriority = '1-URGENT' then date_format(o_orderdate, 'yyyyMMdd') "
                   "when o_orderpriority = '2-HIGH' then date_format(o_orderdate, 'M/d/yyyy') "
                   "else date_format(o_orderdate, 'yyyy-MM-dd') end",
    "o_orderkey": "cast(o_orderkey as string)",
    "o_orderstatus": "o_orderstatus",
    "o_custkey": "cast(o_custkey as string)",
    "o_orderpriority": "o_orderpriority",
}


def write_extract(spark, sf, sep=","):
    """Render orders as CSV text with a header per file; returns the folder."""
    o = table(spark, sf, "orders")
    line = F.concat_ws(sep, *[F.expr(_RENDER[c]) for c in HEADER_ORDER])
    full = F.when(F.expr(_WIDE), F.concat(line, F.lit(sep), F.lit("surplus"))) \
        .when(F.expr(_SHORT), F.substring_index(line, sep, len(HEADER_ORDER) - 1)) \
        .otherwise(line)
    path = scratch_path(spark, "extract")
    # one string column whose name is the header line; a separator that never
    # occurs keeps the writer from quoting the commas inside each line
    (o.select(full.alias(sep.join(HEADER_ORDER)))
      .write.option("header", "true").option("sep", "\u0001").option("quote", "\u0000")
      .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


_GOOD_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_custkey = 19 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
WHERE NOT (o_custkey IN (13, 17, 23) OR ({_WIDE}) OR ({_SHORT}))"""


@query("csv_ingest_by_name", ops="T1 S1 S2 S5 S6 S8 F6", sql=_GOOD_SQL)
def csv_ingest_by_name(spark, sf):
    good, _, _ = I.ingest(spark, ORDERS_SPEC, write_extract(spark, sf))
    return good


@query("csv_ingest_rejects", ops="S3 T1", sql=f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN ({_WIDE}) OR ({_SHORT}) THEN 'width'
              WHEN o_custkey IN (13, 23) THEN 'o_totalprice'
              WHEN o_custkey = 17 THEN 'o_orderdate' END AS reason FROM orders)
WHERE reason IS NOT NULL GROUP BY 1""")
def csv_ingest_rejects(spark, sf):
    _, rejects, _ = I.ingest(spark, ORDERS_SPEC, write_extract(spark, sf))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("csv_ingest_report", ops="S3 S4 S22", sql=f"""
WITH r AS (SELECT count(*) AS rows_read,
                  count(*) FILTER (WHERE o_custkey IN (13, 17, 23) OR ({_WIDE}) OR ({_SHORT})) AS rows_rejected
           FROM orders)
SELECT rows_read, rows_read - rows_rejected AS rows_good, rows_rejected,
       round(rows_rejected / rows_read, 6) AS reject_ratio, 100 AS budget_rows, CAST(0.001 AS DOUBLE) AS budget_ratio,
       NOT (rows_rejected > 100 AND rows_rejected / rows_read > 0.001) AS within_budget
FROM r""")
def csv_ingest_report(spark, sf):
    _, _, report = I.ingest(spark, ORDERS_SPEC, write_extract(spark, sf))
    return report


@query("csv_ingest_tab", ops="S7 S1 T1", sql=_GOOD_SQL)
def csv_ingest_tab(spark, sf):
    good, _, _ = I.ingest(spark, ORDERS_SPEC, write_extract(spark, sf, sep="\t"))
    return good


@query("csv_load_staged", ops="T1 S9 S11 S14 S22", sql=_GOOD_SQL)
def csv_load_staged(spark, sf):
    target = scratch_path(spark, "table")
    I.load(spark, ORDERS_SPEC, write_extract(spark, sf), target, scratch_path(spark, "stage"), mode="overwrite")
    return spark.read.parquet(target)


RANGES = [1996, 1997, ("1998-01-01", "1998-06-30"), ("1998-07-01", "1998-12-31"), 1999, 2000, 2001, 2050]
PLAIN_SPEC = spec("vendor.orders", "o_orderkey:long! o_custkey:long! o_totalprice:double o_orderdate:date!", natural_key=("o_orderkey",))


@query("csv_load_manifest", ops="T1 S1 S4 S14 S21 S25 F10", sql="""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' OR o_orderdate >= TIMESTAMP '1999-01-01'
                  THEN make_date(year(o_orderdate), 1, 1) WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN DATE '1998-01-01' ELSE DATE '1998-07-01' END AS start
           FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2002-01-01')
SELECT start, CAST(count(*) AS BIGINT) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, 'held' AS state FROM r GROUP BY start
UNION ALL SELECT DATE '2050-01-01', 0, NULL, 'missing'""")
def csv_load_manifest(spark, sf):
    """Orders as range files under two column orders: one file loaded, then all, then all again; and the range without a file."""
    ranges = sinks.expand_ranges(spark, RANGES)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    named = o.join(F.broadcast(ranges), o.o_orderdate.between(F.col("start"), F.col("end")) & (F.year("o_orderdate") == F.year("start")))
    folder, target, manifest = (scratch_path(spark, n) for n in ("ranges", "table", "manifest"))
    for even, cols in ((True, PLAIN_SPEC.names), (False, PLAIN_SPEC.names[::-1])):
        named.where((F.year("start") % 2 == 0) == even).select("name", *cols).repartition("name").write.partitionBy("name").mode("append") \
            .option("header", "true").csv(folder)
    # a first run that sees one header's files only, as if the others came later
    M.load_once(spark, PLAIN_SPEC, f"{folder}/name=1996*", target, manifest)
    for _ in range(2):
        M.load_once(spark, PLAIN_SPEC, f"{folder}/name=*", target, manifest)
    rows = M.loaded(spark, PLAIN_SPEC, target, manifest)
    day = F.col("o_orderdate")
    start = F.when(F.year(day) == 1998, F.when(F.month(day) <= 6, F.lit("1998-01-01").cast("date")).otherwise(F.lit("1998-07-01").cast("date"))) \
        .otherwise(F.make_date(F.year(day), F.lit(1), F.lit(1)))
    held = rows.groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("key_sum")).withColumn("state", F.lit("held"))
    gone = M.missing_ranges(ranges, M.current(spark, manifest)).select("start", F.lit(0).cast("long").alias("rows"), F.lit(None).cast("long").alias("key_sum"),
                                                                     F.lit("missing").alias("state"))
    return held.unionByName(gone)
