"""Quality-check queries (D1–D5, D8–D11, A16–A23, W4, W5, O5) on the driver tables.

Stand-in: an analyst-estimate chunk is ``lineitem ⨝ orders`` — ticker =
part, measure = return flag, period = line status, ACTDATS = order date,
FPEDATS = ship date, VALUE = extended price.  Placeholders, zero dates and
the −99999 sentinel are injected deterministically from row attributes, the
same way in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.functions import scalars as S
from quantlake.operators import quality as Q
from quantlake.plans.catalog import query
from quantlake.plans.tables import DerivedFrame, table, with_ctes

ESTIMATES = DerivedFrame(
    name="est",
    source="lineitem", join="orders", on="l_orderkey = o_orderkey",
    cols=(
        ("TICKER", "cast(l_partkey as string)"),
        ("MEASURE", "l_returnflag"),
        ("FPI", "l_linestatus"),
        ("CURR", "o_orderpriority"),
        ("ESTIMATOR", "case when l_linenumber = 7 then '000000' "
                      "when l_linenumber = 6 and l_returnflag = 'N' then '' "
                      "else lpad(cast(l_suppkey as string), 6, '0') end"),
        ("ANALYS", "case when l_linenumber = 5 and l_returnflag = 'A' then '' "
                   "else lpad(cast(o_custkey as string), 6, '0') end"),
        ("ACTDATS", "case when l_linenumber = 4 and l_returnflag = 'R' then DATE '1970-01-01' "
                    "else cast(o_orderdate as date) end"),
        ("FPEDATS", "cast(l_shipdate as date)"),
        ("VALUE", "case when l_linenumber = 3 and l_linestatus = 'O' then null "
                  "when l_linenumber = 2 and l_quantity < 4 then -99999.0 "
                  "else l_extendedprice end"),
        ("ORDERKEY", "l_orderkey"),
        ("LINE", "l_linenumber"),
    ),
)

QC_KEY = ["TICKER", "MEASURE", "FPI", "FPEDATS", "ESTIMATOR", "ANALYS", "ACTDATS", "ORDERKEY"]


def _est(spark, sf):
    return ESTIMATES.frame(spark, sf)


def _null_rules():
    return {
        "pct_value_null": F.col("VALUE").isNull(),
        "pct_actdats_zero": S.is_zero_date("ACTDATS"),
        "pct_fpedats_zero": S.is_zero_date("FPEDATS"),
        "pct_estimator_missing": S.is_missing_code("ESTIMATOR"),
        "pct_analyst_missing": S.is_missing_code("ANALYS"),
    }


_NULL_SQL = """
  round(count(*) FILTER (WHERE VALUE IS NULL) / count(*), 4) AS pct_value_null,
  round(count(*) FILTER (WHERE ACTDATS = DATE '1970-01-01') / count(*), 4) AS pct_actdats_zero,
  round(count(*) FILTER (WHERE FPEDATS = DATE '1970-01-01') / count(*), 4) AS pct_fpedats_zero,
  round(count(*) FILTER (WHERE ESTIMATOR = '' OR ESTIMATOR = '000000') / count(*), 4) AS pct_estimator_missing,
  round(count(*) FILTER (WHERE ANALYS = '' OR ANALYS = '000000') / count(*), 4) AS pct_analyst_missing"""


@query("qc_row_count_and_range", ops="D1 A1 A2 P12", sql=with_ctes(ESTIMATES, body="""
SELECT 'row_count_and_range' AS "check", count(*) AS rows,
       min(ACTDATS) AS min_actdats, max(ACTDATS) AS max_actdats,
       min(FPEDATS) AS min_fpedats, max(FPEDATS) AS max_fpedats
FROM est"""))
def qc_row_count_and_range(spark, sf):
    return Q.row_count_and_range(_est(spark, sf), ["ACTDATS", "FPEDATS"])


@query("qc_row_count_by_measure", ops="D1 by-group", sql=with_ctes(ESTIMATES, body="""
SELECT 'row_count_and_range' AS "check", MEASURE, count(*) AS rows,
       min(ACTDATS) AS min_actdats, max(ACTDATS) AS max_actdats,
       min(FPEDATS) AS min_fpedats, max(FPEDATS) AS max_fpedats
FROM est GROUP BY MEASURE"""))
def qc_row_count_by_measure(spark, sf):
    return Q.row_count_and_range(_est(spark, sf), ["ACTDATS", "FPEDATS"], by="MEASURE")


@query("qc_null_profile", ops="D2 A4 P11 F3 F4", sql=with_ctes(ESTIMATES, body=f"""
SELECT 'null_profile' AS "check", {_NULL_SQL}
FROM est"""))
def qc_null_profile(spark, sf):
    return Q.null_profile(_est(spark, sf), _null_rules())


@query("qc_value_extremes", ops="D3 A2 A3 F1", sql=with_ctes(ESTIMATES, body="""
SELECT 'value_extremes' AS "check", min(VALUE) AS minv, max(VALUE) AS maxv,
       count(*) FILTER (WHERE VALUE = -99999) AS n_neg99999,
       count(*) FILTER (WHERE abs(VALUE) > 1e12) AS n_extreme
FROM est"""))
def qc_value_extremes(spark, sf):
    return Q.value_extremes(_est(spark, sf), "VALUE")


@query("qc_distinct_codes", ops="D4 A5", sql=with_ctes(ESTIMATES, body="""
SELECT 'distinct_codes' AS "check", count(DISTINCT MEASURE) AS n_measure, count(DISTINCT FPI) AS n_fpi,
       count(DISTINCT CURR) AS n_curr, count(DISTINCT TICKER) AS n_ticker
FROM est"""))
def qc_distinct_codes(spark, sf):
    return Q.distinct_codes(_est(spark, sf), ["MEASURE", "FPI", "CURR", "TICKER"])


@query("qc_duplicates", ops="D5 A6", sql="""
SELECT 'duplicates' AS "check",
       CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS dup_rows,
       CAST(count(*) AS BIGINT) AS total_rows
FROM lineitem""")
def qc_duplicates(spark, sf):
    return Q.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("qc_staging_fused", ops="D1-D5 fused into one scan", sql=with_ctes(ESTIMATES, body=f"""
SELECT count(*) AS rows,
       min(ACTDATS) AS min_actdats, max(ACTDATS) AS max_actdats,
       min(FPEDATS) AS min_fpedats, max(FPEDATS) AS max_fpedats, {_NULL_SQL},
       min(VALUE) AS minv, max(VALUE) AS maxv,
       count(*) FILTER (WHERE VALUE = -99999) AS n_neg99999,
       count(*) FILTER (WHERE abs(VALUE) > 1e12) AS n_extreme,
       count(DISTINCT MEASURE) AS n_measure, count(DISTINCT FPI) AS n_fpi,
       count(DISTINCT CURR) AS n_curr, count(DISTINCT TICKER) AS n_ticker,
       CAST(count(*) - count(DISTINCT (TICKER, MEASURE, FPI, FPEDATS, ESTIMATOR, ANALYS, ACTDATS, ORDERKEY)) AS BIGINT)
         AS dup_rows
FROM est"""))
def qc_staging_fused(spark, sf):
    return Q.staging_qc(_est(spark, sf), ["ACTDATS", "FPEDATS"], _null_rules(), "VALUE",
                        ["MEASURE", "FPI", "CURR", "TICKER"], QC_KEY)


# --- duplicates on lineitem's (l_orderkey, l_linenumber) ------------------------
_LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedupe_by_key", ops="W1 D11", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(_LI_ORDER)}) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_by_key(spark, sf):
    li = table(spark, sf, "lineitem")
    out = Q.keep_one(li, ["l_orderkey", "l_linenumber"], _LI_ORDER)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("duplicate_groups", ops="A22", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_groups(spark, sf):
    return Q.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("top_duplicate_years", ops="O5 A22", sql="""
SELECT yr AS period, CAST(sum(n - 1) AS BIGINT) AS surplus
FROM (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n
      FROM lineitem GROUP BY ALL HAVING count(*) > 1)
GROUP BY yr ORDER BY surplus DESC, period LIMIT 3""")
def top_duplicate_years(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("yr", F.year("l_shipdate").cast("int"))
    g = Q.duplicate_groups(li, ["l_orderkey", "l_linenumber", "yr"])
    return (g.groupBy(F.col("yr").alias("period"))
             .agg(F.sum(F.col("n") - 1).cast("long").alias("surplus"))
             .orderBy(F.col("surplus").desc(), F.col("period")).limit(3))


# --- coverage -----------------------------------------------------------------
@query("coverage_by_year", ops="A16 A18 D9", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS period, min(CAST(o_orderdate AS DATE)) AS min_date,
       max(CAST(o_orderdate AS DATE)) AS max_date, count(*) AS rows,
       count(DISTINCT o_custkey) AS securities
FROM orders GROUP BY 1""")
def coverage_by_year(spark, sf):
    return Q.coverage(table(spark, sf, "orders"), "o_orderdate", "o_custkey")


@query("coverage_total", ops="A17 A18", sql="""
SELECT min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date,
       count(*) AS rows, count(DISTINCT o_custkey) AS securities FROM orders""")
def coverage_total(spark, sf):
    return Q.coverage_total(table(spark, sf, "orders"), "o_orderdate", "o_custkey")


@query("coverage_gaps", ops="W4 D9", sql="""
WITH present AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem),
missing AS (SELECT CAST(y AS INTEGER) AS y FROM range(1990, 2006) t(y) WHERE y NOT IN (SELECT y FROM present)),
runs AS (SELECT y, y - row_number() OVER (ORDER BY y) AS grp FROM missing)
SELECT CAST(min(y) AS INTEGER) AS gap_start, CAST(max(y) AS INTEGER) AS gap_end,
       CAST(count(*) AS INTEGER) AS years
FROM runs GROUP BY grp""")
def coverage_gaps(spark, sf):
    cov = Q.coverage(table(spark, sf, "lineitem"), "l_shipdate", "l_partkey")
    return Q.gaps(cov, 1990, 2005)


@query("coverage_anomalies", ops="W5 D9", sql="""
WITH cov AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS rows FROM orders GROUP BY 1)
SELECT period, rows, lag(rows) OVER (ORDER BY period) AS prev_rows,
       round(rows::DOUBLE / lag(rows) OVER (ORDER BY period), 4) AS ratio,
       CASE WHEN round(rows::DOUBLE / lag(rows) OVER (ORDER BY period), 4) < 0.75 THEN 'drop'
            WHEN round(rows::DOUBLE / lag(rows) OVER (ORDER BY period), 4) > 1 / 0.75 THEN 'spike' END AS flag
FROM cov""")
def coverage_anomalies(spark, sf):
    cov = Q.coverage(table(spark, sf, "orders"), "o_orderdate", "o_custkey")
    return Q.anomalies(cov, "rows", 0.75)


@query("distinct_per_period", ops="A20 A21", sql="""
SELECT CAST(ts AS DATE) AS period, min(CAST(ts AS DATE)) AS min_date, max(CAST(ts AS DATE)) AS max_date,
       count(*) AS rows, count(DISTINCT user_id) AS securities
FROM events GROUP BY 1""")
def distinct_per_period(spark, sf):
    return Q.coverage(table(spark, sf, "events"), "ts", "user_id", grain="day")


@query("distinct_per_month_type", ops="A21 by-group", sql="""
SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS period, min(CAST(ts AS DATE)) AS min_date,
       max(CAST(ts AS DATE)) AS max_date, count(*) AS rows, count(DISTINCT user_id) AS securities
FROM events GROUP BY 1, 2""")
def distinct_per_month_type(spark, sf):
    return Q.coverage(table(spark, sf, "events"), "ts", "user_id", grain="month", by="event_type")


# --- sentinel codes ---------------------------------------------------------------
CODED = DerivedFrame(
    name="coded", source="events",
    cols=(
        ("event_id", "event_id"),
        ("event_type", "event_type"),
        ("RET", "case when event_type = 'error' then 'B' when event_type = 'signup' then 'C' "
                "when event_type = 'click' and value > 480 then concat(cast(cast(value as bigint) as string), 'F') "
                "when event_type = 'purchase' and value < 1 then '' "
                "else cast(value as string) end"),
        ("SICCD", "case when user_id < 5 then 'Z' else cast(user_id + 1000 as string) end"),
    ),
)


@query("sentinel_split", ops="P13 F6 P6", sql=with_ctes(CODED, body="""
SELECT event_id, TRY_CAST(RET AS DOUBLE) AS RET_num,
       CASE WHEN RET <> '' AND TRY_CAST(RET AS DOUBLE) IS NULL THEN trim(RET) END AS RET_code,
       RET NOT IN ('B', 'C', '') AS ret_usable
FROM coded"""))
def sentinel_split(spark, sf):
    df = CODED.frame(spark, sf)
    out = Q.split_coded(df, "RET", S.RETURN_CODES)
    return out.select("event_id", "RET_num", "RET_code", (~F.col("RET").isin(*S.RETURN_CODES, "")).alias("ret_usable"))


@query("sentinel_census", ops="D10", sql=with_ctes(CODED, body="""
SELECT "column", code, count(*) AS n FROM (
  SELECT 'RET' AS "column", trim(RET) AS code FROM coded WHERE RET <> '' AND TRY_CAST(RET AS DOUBLE) IS NULL
  UNION ALL
  SELECT 'SICCD', trim(SICCD) FROM coded WHERE SICCD <> '' AND TRY_CAST(SICCD AS DOUBLE) IS NULL)
GROUP BY 1, 2"""))
def sentinel_census(spark, sf):
    return Q.sentinel_census(CODED.frame(spark, sf), ["RET", "SICCD"])


@query("table_totals", ops="A19", sql="""
SELECT * FROM (
  SELECT 'orders' AS "table", count(*) AS rows FROM orders
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'customer', count(*) FROM customer
  UNION ALL SELECT '_total', CAST((SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)
                                 + (SELECT count(*) FROM customer) AS BIGINT))""")
def table_totals(spark, sf):
    return Q.table_totals({n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")})


@query("value_histogram", ops="A14 D14", sql="""
WITH x AS (SELECT l_returnflag, l_discount AS v FROM lineitem),
r AS (SELECT l_returnflag, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1),
b AS (SELECT x.l_returnflag, r.lo, r.hi,
             CASE WHEN r.hi = r.lo THEN 1 ELSE least(CAST(floor(20 * (v - r.lo) / (r.hi - r.lo)) AS INTEGER) + 1, 20) END AS bin
      FROM x JOIN r USING (l_returnflag))
SELECT l_returnflag, bin, round(lo + (bin - 1) * (hi - lo) / 20, 6) AS lo,
       round(CASE WHEN bin = 20 THEN hi ELSE lo + bin * (hi - lo) / 20 END, 6) AS hi, count(*) AS n
FROM b GROUP BY l_returnflag, bin, b.lo, b.hi""")
def value_histogram(spark, sf):
    h = Q.histogram(table(spark, sf, "lineitem"), "l_discount", bins=20, by="l_returnflag")
    return h.select("l_returnflag", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@query("sorted_codes", ops="A11 O2", sql="""
SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL ORDER BY 1""")
def sorted_codes(spark, sf):
    return Q.sorted_codes(table(spark, sf, "orders"), "o_orderpriority")


@query("spot_check", ops="O3", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def spot_check(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return Q.spot_check(o, 10, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("coverage_anomalies_trailing", ops="W5 D9", sql="""
WITH cov AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS rows FROM orders GROUP BY 1),
b AS (SELECT period, rows, median(CAST(rows AS DOUBLE)) OVER (ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m
      FROM cov)
SELECT period, rows, m AS trailing_median_rows, round(rows / m, 4) AS ratio,
       CASE WHEN round(rows / m, 4) < 0.8 THEN 'drop' WHEN round(rows / m, 4) > 1 / 0.8 THEN 'spike' END AS flag
FROM b""")
def coverage_anomalies_trailing(spark, sf):
    cov = Q.coverage(table(spark, sf, "orders"), "o_orderdate", "o_custkey", grain="month")
    return Q.anomalies(cov, "rows", 0.8, trailing=3)
