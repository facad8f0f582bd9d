"""Point-in-time and interval queries.

Stand-ins: link / name intervals are derived per customer from ``orders``
(an order opens an interval that ends the day before the customer's next
order; the last stays open, rendered ``'E'``).  Inside ``events`` (no
(user, ts) ties): estimates = ``view``, observations = ``purchase``, stops /
exclusion windows = ``error``, identifier records = ``signup``, split factors
= ``signup`` with ``adj = 1 + event_id % 2``.  Events and orders are never
mixed on time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.operators import adjust as ADJ
from quantlake.operators import asof as A
from quantlake.operators import intervals as IV
from quantlake.operators import quality as Q
from quantlake.plans.catalog import query
from quantlake.plans.tables import table

# --- customer intervals from orders ------------------------------------------------
_LINKS_SQL = """links AS (
  SELECT gvkey, LPERMNO, LINKDT, ticker, nxt,
         CASE WHEN nxt IS NULL THEN 'E' ELSE strftime(nxt - 1, '%Y-%m-%d') END AS LINKENDDT
  FROM (SELECT o_custkey AS gvkey, o_orderkey AS LPERMNO, CAST(o_orderdate AS DATE) AS LINKDT,
               o_orderpriority AS ticker,
               lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt
        FROM orders)
  WHERE nxt IS NULL OR nxt - 1 >= LINKDT)"""
_FACT_SQL = """fact AS (
  SELECT l_orderkey, l_linenumber, o_custkey AS gvkey, CAST(l_shipdate AS DATE) AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _links(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("gvkey"), F.col("o_orderkey").alias("LPERMNO"),
        F.col("o_orderdate").cast("date").alias("LINKDT"), F.col("o_orderpriority").alias("ticker"))
    v = A.valid_to_next(o, ["gvkey"], "LINKDT", ["LPERMNO"], out="_end")
    v = v.where(F.col("_end").isNull() | (F.col("_end") >= F.col("LINKDT")))
    return v.withColumn("LINKENDDT", F.when(F.col("_end").isNull(), F.lit("E"))
                        .otherwise(F.date_format("_end", "yyyy-MM-dd"))) \
            .withColumn("nxt", F.date_add("_end", 1)).drop("_end")


def _fact(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("gvkey"), F.col("l_shipdate").cast("date").alias("d"))


@query("open_interval_links", ops="P7 A23 W6 F7", sql=f"""
WITH {_LINKS_SQL}
SELECT CASE WHEN LINKENDDT IS NULL OR LINKENDDT IN ('', 'E') THEN 'open'
            WHEN TRY_CAST(LINKENDDT AS DATE) IS NOT NULL THEN 'dated' ELSE 'invalid' END AS status,
       count(*) AS n
FROM links GROUP BY 1""")
def open_interval_links(spark, sf):
    return Q.end_status_counts(_links(spark, sf), "LINKENDDT")


@query("link_join_on_date", ops="J10 J9 J8", sql=f"""
WITH {_LINKS_SQL}, {_FACT_SQL}
SELECT f.l_orderkey, f.l_linenumber, k.LPERMNO
FROM fact f LEFT JOIN links k ON k.gvkey = f.gvkey AND f.d >= k.LINKDT
  AND f.d <= CASE WHEN k.LINKENDDT IN ('', 'E') THEN DATE '9999-12-31' ELSE CAST(k.LINKENDDT AS DATE) END""")
def link_join_on_date(spark, sf):
    j = IV.interval_join(_fact(spark, sf), _links(spark, sf), ["gvkey"], "d", "LINKDT", "LINKENDDT",
                         dim_cols=["LPERMNO"])
    return j.select("l_orderkey", "l_linenumber", "LPERMNO")


@query("name_history_join", ops="J11", sql=f"""
WITH {_LINKS_SQL}, {_FACT_SQL}
SELECT f.l_orderkey, f.l_linenumber, k.ticker
FROM fact f JOIN links k ON k.gvkey = f.gvkey AND f.d >= k.LINKDT AND (k.nxt IS NULL OR f.d < k.nxt)""")
def name_history_join(spark, sf):
    j = IV.interval_join(_fact(spark, sf), _links(spark, sf), ["gvkey"], "d", "LINKDT", "nxt",
                         closed="left", how="inner", dim_cols=["ticker"])
    return j.select("l_orderkey", "l_linenumber", "ticker")


@query("id_chain_dated", ops="J13 J10", sql=f"""
WITH {_LINKS_SQL}, {_FACT_SQL},
codes AS (SELECT o_orderkey AS LPERMNO, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 60 AS e, o_orderpriority AS code FROM orders
          UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) + 61, DATE '9999-12-31', o_orderstatus FROM orders)
SELECT f.l_orderkey, f.l_linenumber, c.LPERMNO, c.code
FROM fact f LEFT JOIN (SELECT k.gvkey, k.LPERMNO, k.LINKDT, CASE WHEN k.LINKENDDT IN ('', 'E') THEN DATE '9999-12-31' ELSE CAST(k.LINKENDDT AS DATE) END AS le,
                              c.s, c.e, c.code FROM links k JOIN codes c USING (LPERMNO)) c
  ON c.gvkey = f.gvkey AND f.d BETWEEN c.LINKDT AND c.le AND f.d BETWEEN c.s AND c.e""")
def id_chain_dated(spark, sf):
    """Firm to security to code, each link with its own dates; the code of a security changes inside the firm's link."""
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    codes = o.select(F.col("o_orderkey").alias("LPERMNO"), day.alias("LINKDT"), F.date_format(F.date_add(day, 60), "yyyy-MM-dd").alias("LINKENDDT"),
                     F.col("o_orderpriority").alias("code")).unionByName(
        o.select(F.col("o_orderkey").alias("LPERMNO"), F.date_add(day, 61).alias("LINKDT"), F.lit("E").alias("LINKENDDT"), F.col("o_orderstatus").alias("code")))
    chain = IV.compose_links(_links(spark, sf).select("gvkey", "LPERMNO", "LINKDT", "LINKENDDT"), codes, ["LPERMNO"], "LINKDT", "LINKENDDT")
    j = IV.interval_join(_fact(spark, sf), chain, ["gvkey"], "d", "LINKDT", "LINKENDDT", dim_cols=["LPERMNO", "code"])
    return j.select("l_orderkey", "l_linenumber", "LPERMNO", "code")


_MEM_SQL = """mem AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS s,
                      CAST(o_orderdate AS DATE) + 30 AS e FROM orders)"""


def _membership(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("gvkey"),
                                             F.col("o_orderdate").cast("date").alias("s"),
                                             F.date_add(F.col("o_orderdate").cast("date"), 30).alias("e"))


@query("membership_filter", ops="J12", sql=f"""
WITH {_MEM_SQL}, {_FACT_SQL}
SELECT l_orderkey, l_linenumber, d FROM fact f
WHERE EXISTS (SELECT 1 FROM mem m WHERE m.k = f.gvkey AND f.d BETWEEN m.s AND m.e)""")
def membership_filter(spark, sf):
    j = IV.interval_join(_fact(spark, sf), _membership(spark, sf), ["gvkey"], "d", "s", "e", how="left_semi")
    return j.select("l_orderkey", "l_linenumber", "d")


@query("merge_intervals", ops="W7", sql=f"""
WITH {_MEM_SQL},
o AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe
      FROM mem),
f AS (SELECT *, CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END AS nw FROM o),
g AS (SELECT *, sum(nw) OVER (PARTITION BY k ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT k AS gvkey, min(s) AS s, max(e) AS e, count(*) AS n_merged FROM g GROUP BY k, island""")
def merge_intervals(spark, sf):
    return IV.merge_intervals(_membership(spark, sf), ["gvkey"], "s", "e")


# --- events: estimates, observations, stops ----------------------------------------
def _ev(spark, sf, kind, id_name, ts_name="ts", extra=()):
    e = table(spark, sf, "events").where(F.col("event_type") == kind)
    return e.select("user_id", F.col("event_id").alias(id_name), F.col("ts").alias(ts_name), *extra)


@query("pit_latest_estimate", ops="J14", sql="""
SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id, v.value AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def pit_latest_estimate(spark, sf):
    left = _ev(spark, sf, "purchase", "purchase_id")
    right = _ev(spark, sf, "view", "view_id", "vts", [F.col("value").alias("view_value")])
    j = A.asof_join(left, right, ["user_id"], "ts", "vts", ["view_id", "view_value"], tie_break=["view_id"])
    return j.select("user_id", "purchase_id", "view_id", "view_value")


@query("surprise", ops="J22 J14", sql="""
SELECT p.user_id, p.event_id AS purchase_id, p.value AS actual, v.value AS mean_est,
       p.value - v.value AS surprise, (p.value - v.value) / NULLIF(abs(v.value), 0) AS surprise_pct
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def surprise(spark, sf):
    left = _ev(spark, sf, "purchase", "purchase_id")
    right = _ev(spark, sf, "view", "view_id", "vts", [F.col("value").alias("mean_est")])
    est = A.asof_join(left, right, ["user_id"], "ts", "vts", ["mean_est"]).where(F.col("mean_est").isNotNull())
    actual = _ev(spark, sf, "purchase", "purchase_id", extra=[F.col("value").alias("actual")]).drop("ts")
    s = A.surprise(actual, est.drop("ts"), ["user_id", "purchase_id"])
    # single IEEE operations in both engines: exact, so not rounded; a zero estimate gives NULL
    return s.select("user_id", "purchase_id", "actual", "mean_est", "surprise", "surprise_pct")


@query("restatement_latest", ops="W2", sql="""
SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderdate <= DATE '1999-12-31')
WHERE rn = 1""")
def restatement_latest(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey",
                                          F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")
    return A.latest_restatement(o, ["o_custkey", "o_orderpriority"], "1999-12-31", ["o_orderdate", "o_orderkey"])


@query("exclusion_anti_join", ops="J16", sql="""
SELECT e.event_id, e.user_id, e.event_type FROM events e
WHERE e.event_type IN ('view', 'click') AND NOT EXISTS (
  SELECT 1 FROM events x WHERE x.event_type = 'error' AND x.user_id = e.user_id
    AND CAST(e.ts AS DATE) BETWEEN CAST(x.ts AS DATE) AND CAST(x.ts AS DATE) + 2)""")
def exclusion_anti_join(spark, sf):
    ev = table(spark, sf, "events")
    est = ev.where(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "event_type",
                                                                      F.col("ts").cast("date").alias("d"))
    win = ev.where(F.col("event_type") == "error").select(
        "user_id", F.col("ts").cast("date").alias("EXCDATS"), F.date_add(F.col("ts").cast("date"), 2).alias("EXCENDS"))
    return IV.exclude_windows(est, win, ["user_id"], "d", "EXCDATS", "EXCENDS").select("event_id", "user_id", "event_type")


@query("stop_valid_to", ops="J17", sql="""
SELECT v.user_id, v.event_id AS view_id, e.event_id AS stop_id
FROM (SELECT * FROM events WHERE event_type = 'view') v
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON v.user_id = e.user_id AND v.ts <= e.ts""")
def stop_valid_to(spark, sf):
    est = _ev(spark, sf, "view", "view_id")
    stops = _ev(spark, sf, "error", "stop_id", "sts")
    j = A.asof_join(est, stops, ["user_id"], "ts", "sts", ["stop_id"], direction="forward")
    return j.select("user_id", "view_id", "stop_id")


@query("stop_by_broker", ops="J18", sql="""
SELECT c.user_id, c.event_id AS click_id, p.event_id AS stop_id, CAST(p.ts AS DATE) AS valid_to
FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts < p.ts""")
def stop_by_broker(spark, sf):
    est = _ev(spark, sf, "click", "click_id")
    stops = _ev(spark, sf, "purchase", "stop_id", "sts").withColumn("valid_to", F.col("sts").cast("date"))
    j = A.asof_join(est, stops, ["user_id"], "ts", "sts", ["stop_id", "valid_to"], strict=True, direction="forward")
    return j.select("user_id", "click_id", "stop_id", "valid_to")


@query("identifier_asof", ops="J19 J14", sql="""
SELECT c.user_id, c.event_id AS click_id, s.event_id AS signup_id
FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON c.user_id = s.user_id AND c.ts >= s.ts""")
def identifier_asof(spark, sf):
    left = _ev(spark, sf, "click", "click_id")
    right = _ev(spark, sf, "signup", "signup_id", "sts")
    return A.asof_join(left, right, ["user_id"], "ts", "sts", ["signup_id"]).select("user_id", "click_id", "signup_id")


@query("identifier_valid_to", ops="W6", sql="""
SELECT user_id, event_id AS signup_id, CAST(ts AS DATE) AS valid_from,
       CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS DATE) - 1 AS valid_to
FROM events WHERE event_type = 'signup'""")
def identifier_valid_to(spark, sf):
    s = _ev(spark, sf, "signup", "signup_id")
    v = A.valid_to_next(s, ["user_id"], "ts", ["signup_id"])
    return v.select("user_id", "signup_id", F.col("ts").cast("date").alias("valid_from"), "valid_to")


# --- estimate panel and consensus ----------------------------------------------------
@query("consensus_panel", ops="A24 T6 W6", sql="""
WITH est AS (
  SELECT o_orderpriority AS measure, o_custkey AS estimator, CAST(o_orderdate AS DATE) AS d,
         o_totalprice * 0.7071067811865476 AS value,
         least(coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority, o_custkey
                                                              ORDER BY o_orderdate, o_orderkey) - 1,
                        DATE '2001-12-31'), DATE '2001-12-31') AS vt
  FROM orders),
est2 AS (SELECT *, CASE WHEN CAST(date_trunc('quarter', d) AS DATE) < d
                        THEN CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE)
                        ELSE CAST(date_trunc('quarter', d) AS DATE) END AS q0 FROM est),
panel AS (SELECT measure, estimator, value, CAST(unnest(generate_series(q0, vt, INTERVAL 3 MONTH)) AS DATE) AS obs_date
          FROM est2 WHERE q0 <= vt)
SELECT measure, obs_date, count(value) AS n_est, round(avg(value), 6) AS mean_est,
       round(stddev_samp(value), 6) AS std_est, max(value) AS high_est, min(value) AS low_est,
       round(median(value), 6) AS median_est
FROM panel GROUP BY measure, obs_date""")
def consensus_panel(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("measure"),
                                          F.col("o_custkey").alias("estimator"), "o_orderkey",
                                          F.col("o_orderdate").cast("date").alias("d"),
                                          # scaled by 1/sqrt(2): no consensus average sits exactly on a rounding tie
                                          (F.col("o_totalprice") * F.lit(0.7071067811865476)).alias("value"))
    panel = A.estimate_panel(o, ["measure"], "estimator", "d", "value", end="2001-12-31", tie_break=["o_orderkey"])
    return A.consensus(panel, ["measure", "obs_date"])


# --- split adjustment ------------------------------------------------------------------
@query("split_unadjust", ops="W3 J15 T7", sql="""
SELECT v.user_id, v.event_id AS view_id, v.value AS adjusted,
       v.value * coalesce((SELECT product(1 + s.event_id % 2) FROM events s
                           WHERE s.event_type = 'signup' AND s.user_id = v.user_id AND s.ts > v.ts), 1.0) AS unadjusted
FROM events v WHERE v.event_type = 'view'""")
def split_unadjust(spark, sf):
    ev = table(spark, sf, "events")
    splits = ev.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("SPDATES"), (F.lit(1) + F.col("event_id") % 2).cast("double").alias("ADJ"),
        F.col("event_id").alias("split_id"))
    vals = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), "ts", F.col("value").alias("adjusted"),
        F.col("value").alias("unadjusted"))
    out = ADJ.unadjust(vals, splits, ["user_id"], "ts", ["unadjusted"], tie_break=["split_id"])
    return out.select("user_id", "view_id", "adjusted", "unadjusted")


@query("fundamentals_via_link", ops="T9 J10 J14 J8", sql=f"""
WITH {_LINKS_SQL},
fund AS (SELECT o_custkey AS gvkey, o_orderkey AS report_id, CAST(o_orderdate AS DATE) + 45 AS rdq,
                o_totalprice AS report_value FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
px AS (SELECT l_orderkey AS PERMNO, l_linenumber, CAST(l_shipdate AS DATE) AS date FROM lineitem),
linked AS (SELECT px.*, k.gvkey FROM px LEFT JOIN links k ON k.LPERMNO = px.PERMNO AND px.date >= k.LINKDT
           AND px.date <= CASE WHEN k.LINKENDDT IN ('', 'E') THEN DATE '9999-12-31' ELSE CAST(k.LINKENDDT AS DATE) END)
SELECT l.PERMNO, l.l_linenumber, l.gvkey, f.report_id, f.report_value
FROM linked l ASOF LEFT JOIN fund f ON l.gvkey = f.gvkey AND l.date >= f.rdq""")
def fundamentals_via_link(spark, sf):
    from quantlake.operators.panel import fundamentals_panel
    from quantlake.operators.quality import keep_one
    o = table(spark, sf, "orders")
    fund = o.select(F.col("o_custkey").alias("gvkey"), F.col("o_orderkey").alias("report_id"),
                    F.date_add(F.col("o_orderdate").cast("date"), 45).alias("rdq"), F.col("o_totalprice").alias("report_value"))
    fund = keep_one(fund, ["gvkey", "rdq"], [-F.col("report_id")])
    px = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("PERMNO"), "l_linenumber",
                                             F.col("l_shipdate").cast("date").alias("date"))
    j = fundamentals_panel(px, fund, _links(spark, sf), "rdq", cols=["report_id", "report_value"], tie_break=["report_id"])
    return j.select("PERMNO", "l_linenumber", "gvkey", "report_id", "report_value")


@query("consensus_panel_full", ops="T6 A24 J16 J17 W6", sql="""
WITH est AS (
  SELECT o_orderpriority AS measure, o_custkey AS estimator, CAST(o_orderdate AS DATE) AS d,
         o_totalprice * 0.7071067811865476 AS value,
         lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS vt
  FROM orders),
stops AS (SELECT o_orderpriority AS measure, o_custkey AS estimator, CAST(o_orderdate AS DATE) + 200 AS stop
          FROM orders WHERE o_orderstatus = 'F'),
excl AS (SELECT o_orderpriority AS measure, o_custkey AS estimator, CAST(o_orderdate AS DATE) + 30 AS xs,
                CAST(o_orderdate AS DATE) + 120 AS xe FROM orders WHERE o_orderstatus = 'P'),
est_s AS (SELECT e.*, s.stop FROM est e ASOF LEFT JOIN stops s
          ON e.measure = s.measure AND e.estimator = s.estimator AND e.d <= s.stop),
est2 AS (SELECT *, least(coalesce(vt, DATE '2001-12-31'), coalesce(stop - 1, DATE '2001-12-31'), DATE '2001-12-31') AS vt2,
                CASE WHEN CAST(date_trunc('quarter', d) AS DATE) < d
                     THEN CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE)
                     ELSE CAST(date_trunc('quarter', d) AS DATE) END AS q0 FROM est_s),
panel AS (SELECT measure, estimator, value, CAST(unnest(generate_series(q0, vt2, INTERVAL 3 MONTH)) AS DATE) AS obs_date
          FROM est2 WHERE q0 <= vt2),
kept AS (SELECT * FROM panel p WHERE NOT EXISTS (
           SELECT 1 FROM excl x WHERE x.measure = p.measure AND x.estimator = p.estimator
             AND p.obs_date BETWEEN x.xs AND x.xe))
SELECT measure, obs_date, count(value) AS n_est, round(avg(value), 6) AS mean_est,
       round(stddev_samp(value), 6) AS std_est, max(value) AS high_est, min(value) AS low_est,
       round(median(value), 6) AS median_est
FROM kept GROUP BY measure, obs_date""")
def consensus_panel_full(spark, sf):
    o = table(spark, sf, "orders")
    est = o.select(F.col("o_orderpriority").alias("measure"), F.col("o_custkey").alias("estimator"), "o_orderkey",
                   F.col("o_orderdate").cast("date").alias("d"),
                   (F.col("o_totalprice") * F.lit(0.7071067811865476)).alias("value"))
    stops = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderpriority").alias("measure"), F.col("o_custkey").alias("estimator"),
        F.date_add(F.col("o_orderdate").cast("date"), 200).alias("stop"))
    excl = o.where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderpriority").alias("measure"), F.col("o_custkey").alias("estimator"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("xs"),
        F.date_add(F.col("o_orderdate").cast("date"), 120).alias("xe"))
    panel = A.estimate_panel(est, ["measure"], "estimator", "d", "value", end="2001-12-31", stops=stops,
                             stop_at="stop", excluded=excl, exc_start="xs", exc_end="xe", tie_break=["o_orderkey"])
    return A.consensus(panel, ["measure", "obs_date"])
