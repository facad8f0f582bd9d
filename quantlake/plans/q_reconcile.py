"""Reconciliation queries.

Stand-in: vendor A and vendor B publish a daily price per contract.  A
contract is a (return flag, line status) pair of ``lineitem``; A's price is
the day's lowest extended price / 100 (exact in both engines), B's last and
settle prices are A's plus a deterministic offset that depends on the day of
month (0, 0.004, 0.05 or 0.60, each × 1.06066 = 3/(2·sqrt 2), so that no mean
difference lands exactly on a rounding tie while the offsets stay on the same
side of the 0.005 / 0.10 / 0.50 tolerances).  B misses the first day of each month, A has
no price on the 7th, and one mapped code has no B rows at all.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.operators import reconcile as R
from quantlake.plans.catalog import query
from quantlake.plans.tables import DerivedFrame, with_ctes

VENDOR_A = DerivedFrame(
    name="va", source="lineitem",
    cols=(("contract", "concat('c', l_returnflag, l_linestatus)"),
          ("date", "cast(l_shipdate as date)"),
          ("a_price", "case when day(cast(l_shipdate as date)) = 7 then null "
                      "else min(l_extendedprice) / 100.0 end"),
          ("a_oi", "count(*)")),
    group_by=("contract", "date"),
)
VENDOR_B = DerivedFrame(
    name="vb", source="lineitem",
    cols=(("ric", "concat('R', l_returnflag, l_linestatus)"),
          ("date", "cast(l_shipdate as date)"),
          ("b_last", "case when day(cast(l_shipdate as date)) = 13 then null "
                     "else min(l_extendedprice) / 100.0 + case "
                     "when day(cast(l_shipdate as date)) % 7 = 0 then 0.6 * 1.0606601717798212 "
                     "when day(cast(l_shipdate as date)) % 5 = 0 then 0.05 * 1.0606601717798212 "
                     "when day(cast(l_shipdate as date)) % 3 = 0 then 0.004 * 1.0606601717798212 else 0.0 end end"),
          ("b_settle", "min(l_extendedprice) / 100.0 + case "
                       "when day(cast(l_shipdate as date)) % 4 = 0 then 0.6 * 1.0606601717798212 "
                       "else 0.001 * 1.0606601717798212 end"),
          ("b_oi", "count(*) + day(cast(l_shipdate as date)) % 3")),
    where="day(l_shipdate) <> 1",
    group_by=("ric", "date"),
)
# contract → vendor-B code; the N/F contract maps to an expired code B does not carry
MAPPING = DerivedFrame(
    name="mapping", source="lineitem",
    cols=(("contract", "concat('c', l_returnflag, l_linestatus)"),
          ("ric", "case when l_returnflag = 'N' and l_linestatus = 'F' then 'RNF^2' "
                  "else concat('R', l_returnflag, l_linestatus) end")),
    group_by=("contract", "ric"),
)
_CTES = (VENDOR_A, VENDOR_B, MAPPING)
_ALIGNED = """aligned AS (
  SELECT va.contract, va.date, va.a_price, va.a_oi, vb.ric, vb.b_last, vb.b_settle, vb.b_oi
  FROM (SELECT * FROM va WHERE a_price IS NOT NULL) va JOIN mapping USING (contract)
  JOIN vb ON vb.ric = mapping.ric AND vb.date = va.date)"""


def _aligned(spark, sf):
    a = VENDOR_A.frame(spark, sf).dropna(subset=["a_price"])
    return R.align(a, VENDOR_B.frame(spark, sf), MAPPING.frame(spark, sf))


def _summary_sql():
    parts = []
    for lab, col in (("last", "b_last"), ("settle", "b_settle")):
        d = f"(a_price - {col})"
        parts.append(f"""round(avg({d}), 4) AS vs_{lab}_mean_diff,
       round(median({d}), 4) AS vs_{lab}_median_diff,
       round(max(abs({d})), 4) AS vs_{lab}_max_abs_diff,
       round(avg(CASE WHEN abs({d}) < 0.005 THEN 1.0 ELSE 0.0 END), 4) AS vs_{lab}_exact_pct,
       round(avg(CASE WHEN abs({d}) < 0.10 THEN 1.0 ELSE 0.0 END), 4) AS vs_{lab}_close_pct""")
    return ",\n       ".join(parts)


@query("reconcile_summary", ops="D12 J4 J5 A7 A8 A9 A10 A25 P8",
       sql=with_ctes(*_CTES, extra=_ALIGNED, body=f"""
SELECT contract, ric, count(*) AS n_matched,
       {_summary_sql()}
FROM aligned GROUP BY contract, ric"""))
def reconcile_summary(spark, sf):
    return R.reconcile_summary(_aligned(spark, sf), code="ric")


@query("reconcile_counts", ops="A15 J4", sql=with_ctes(*_CTES, extra=_ALIGNED, body="""
SELECT m.contract, m.ric, coalesce(a.n, 0) AS a_rows, coalesce(b.n, 0) AS b_rows,
       coalesce(x.n, 0) AS matched_rows
FROM mapping m
LEFT JOIN (SELECT contract, count(*) AS n FROM va WHERE a_price IS NOT NULL GROUP BY 1) a USING (contract)
LEFT JOIN (SELECT ric, count(*) AS n FROM vb GROUP BY 1) b ON b.ric = m.ric
LEFT JOIN (SELECT contract, count(*) AS n FROM aligned GROUP BY 1) x ON x.contract = m.contract"""))
def reconcile_counts(spark, sf):
    a = VENDOR_A.frame(spark, sf).dropna(subset=["a_price"])
    return R.side_counts(a, VENDOR_B.frame(spark, sf), MAPPING.frame(spark, sf))


@query("reconcile_unmatched", ops="J6 U5", sql=with_ctes(*_CTES, body="""
SELECT contract, ric FROM mapping m WHERE NOT EXISTS (SELECT 1 FROM vb WHERE vb.ric = m.ric)"""))
def reconcile_unmatched(spark, sf):
    return R.unmatched_codes(MAPPING.frame(spark, sf), VENDOR_B.frame(spark, sf))


@query("reconcile_outliers", ops="D13 P9 P10", sql=with_ctes(*_CTES, extra=_ALIGNED, body="""
SELECT contract, date, a_price, b_last, b_settle, a_price - b_last AS diff_b_last,
       a_price - b_settle AS diff_b_settle
FROM aligned WHERE abs(a_price - b_last) > 0.5 AND abs(a_price - b_settle) > 0.5"""))
def reconcile_outliers(spark, sf):
    return R.outliers(_aligned(spark, sf))


def _histogram_sql(field):
    return with_ctes(*_CTES, extra=_ALIGNED + f""",
x AS (SELECT contract, a_price - {field} AS v FROM aligned WHERE {field} IS NOT NULL),
r AS (SELECT contract, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1),
b AS (SELECT x.contract, r.lo, r.hi,
             CASE WHEN r.hi = r.lo THEN 1
                  ELSE least(CAST(floor(50 * (v - r.lo) / (r.hi - r.lo)) AS INTEGER) + 1, 50) END AS bin
      FROM x JOIN r USING (contract))""", body="""
SELECT contract, bin, round(lo + (bin - 1) * (hi - lo) / 50, 6) AS lo,
       round(CASE WHEN bin = 50 THEN hi ELSE lo + bin * (hi - lo) / 50 END, 6) AS hi, count(*) AS n
FROM b GROUP BY contract, bin, b.lo, b.hi""")


def _difference_histogram(spark, sf, field):
    m = _aligned(spark, sf).withColumn("diff", F.col("a_price") - F.col(field))
    h = R.histogram(m, "diff", bins=50, by="contract")
    return h.select("contract", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@query("reconcile_histogram", ops="D14 A14", sql=_histogram_sql("b_last"))
def reconcile_histogram(spark, sf):
    return _difference_histogram(spark, sf, "b_last")


@query("reconcile_histogram_settle", ops="D14 A14", sql=_histogram_sql("b_settle"))
def reconcile_histogram_settle(spark, sf):
    return _difference_histogram(spark, sf, "b_settle")


@query("reconcile_series", ops="D15 O1 P2 P3 P14", sql=with_ctes(*_CTES, extra=_ALIGNED, body="""
SELECT contract, date, a_price AS price_a, b_last AS last_b, b_settle AS settle_b,
       a_oi AS oi_a, b_oi AS oi_b
FROM aligned WHERE regexp_matches(contract, '^c[AR]') ORDER BY contract, date"""))
def reconcile_series(spark, sf):
    m = _aligned(spark, sf).where(F.col("contract").rlike("^c[AR]"))
    m = m.withColumnsRenamed({"a_price": "price_a", "b_last": "last_b", "b_settle": "settle_b",
                              "a_oi": "oi_a", "b_oi": "oi_b"})
    return R.series(m, ["price_a", "last_b", "settle_b", "oi_a", "oi_b"])


@query("corr_matrix", ops="D16 A12 A13 U1", sql=with_ctes(*_CTES, extra=_ALIGNED, body="""
SELECT v1 AS var1, v2 AS var2, round(c, 6) AS corr FROM (
  SELECT 'a_price' v1, 'a_price' v2, corr(a_price, a_price) c FROM aligned UNION ALL
  SELECT 'a_price', 'b_last', corr(a_price, b_last) FROM aligned UNION ALL
  SELECT 'a_price', 'b_settle', corr(a_price, b_settle) FROM aligned UNION ALL
  SELECT 'b_last', 'a_price', corr(b_last, a_price) FROM aligned UNION ALL
  SELECT 'b_last', 'b_last', corr(b_last, b_last) FROM aligned UNION ALL
  SELECT 'b_last', 'b_settle', corr(b_last, b_settle) FROM aligned UNION ALL
  SELECT 'b_settle', 'a_price', corr(b_settle, a_price) FROM aligned UNION ALL
  SELECT 'b_settle', 'b_last', corr(b_settle, b_last) FROM aligned UNION ALL
  SELECT 'b_settle', 'b_settle', corr(b_settle, b_settle) FROM aligned)"""))
def corr_matrix(spark, sf):
    return R.corr_matrix(_aligned(spark, sf), ["a_price", "b_last", "b_settle"])


@query("corr_open_interest", ops="D16 A12", sql=with_ctes(*_CTES, extra=_ALIGNED, body="""
SELECT v1 AS var1, v2 AS var2, round(c, 6) AS corr FROM (
  SELECT 'a_oi' v1, 'a_oi' v2, corr(a_oi, a_oi) c FROM aligned UNION ALL
  SELECT 'a_oi', 'b_oi', corr(a_oi, b_oi) FROM aligned UNION ALL
  SELECT 'b_oi', 'a_oi', corr(b_oi, a_oi) FROM aligned UNION ALL
  SELECT 'b_oi', 'b_oi', corr(b_oi, b_oi) FROM aligned)"""))
def corr_open_interest(spark, sf):
    return R.corr_matrix(_aligned(spark, sf), ["a_oi", "b_oi"])
