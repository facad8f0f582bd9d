"""Panel, option-chain, curve and scalar-function queries.

Stand-ins: daily prices = ``lineitem`` (security = part, date = ship date,
price = extended price); an option chain = ``lineitem`` with the return
flag as call/put; a zero curve = ``orders`` per order date and priority;
identifier chain = lineitem → supplier → nation → region; returns per
``events`` user (strictly increasing ts).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantlake.functions import scalars as S
from quantlake.operators import asof as A
from quantlake.operators import curve as C
from quantlake.operators import panel as P
from quantlake.operators.quality import keep_one
from quantlake.plans.catalog import query
from quantlake.plans.tables import DerivedFrame, table, with_ctes

# --- unified old/new daily stock ------------------------------------------------------
OLD = DerivedFrame("old", "lineitem", (
    ("PERMNO", "l_partkey"), ("date", "cast(l_shipdate as date)"), ("PRC", "l_extendedprice"),
    ("VOL", "cast(l_quantity as bigint)"), ("CFACPR", "1.0 + l_tax")),
    where="l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")
NEW = DerivedFrame("new", "lineitem", (
    ("PERMNO", "l_partkey"), ("DlyCalDt", "cast(l_shipdate as date)"), ("DlyPrc", "l_extendedprice"),
    ("DlyVol", "cast(l_quantity as bigint)"), ("DlyFacPrc", "1.0 + l_discount")),
    where="l_shipdate >= TIMESTAMP '1997-07-01 00:00:00'")


@query("union_formats", ops="T8 U3 U4", sql=with_ctes(OLD, NEW, body="""
SELECT PERMNO, DlyCalDt, DlyPrc, DlyVol, DlyFacPrc, NULL::DOUBLE AS CFACPR, 'new' AS source FROM new
UNION ALL
SELECT PERMNO, date AS DlyCalDt, PRC AS DlyPrc, VOL AS DlyVol, NULL::DOUBLE AS DlyFacPrc, CFACPR, 'old' AS source
FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.PERMNO = o.PERMNO AND n.DlyCalDt = o.date)"""))
def union_formats(spark, sf):
    m = {"date": "DlyCalDt", "PRC": "DlyPrc", "VOL": "DlyVol"}
    return P.union_formats(OLD.frame(spark, sf), NEW.frame(spark, sf), m, ["PERMNO", "DlyCalDt"])


# --- identifiers -------------------------------------------------------------------------
@query("company_enrich", ops="J8 J20", sql="""
SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey, p_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey""")
def company_enrich(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return P.enrich(P.enrich(li, s, ["l_suppkey"]), p, ["l_partkey"]).drop("l_partkey")


@query("id_chain", ops="J13", sql="""
SELECT l_orderkey, l_linenumber, s_nationkey, n_regionkey, r_name,
       CASE WHEN s.s_suppkey IS NULL THEN 0 WHEN n.n_nationkey IS NULL THEN 1
            WHEN r.r_regionkey IS NULL THEN 2 ELSE 3 END AS matched_step
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def id_chain(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    links = [(table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ["s_nationkey"]),
             (table(spark, sf, "nation"), "s_nationkey", "n_nationkey", ["n_regionkey"]),
             (table(spark, sf, "region"), "n_regionkey", "r_regionkey", ["r_name"])]
    return P.chain(li, links).select("l_orderkey", "l_linenumber", "s_nationkey", "n_regionkey", "r_name",
                                     "matched_step")


@query("fundamentals_prices", ops="T9 J8 J14", sql="""
WITH prices AS (SELECT l_orderkey, l_linenumber, o_custkey AS gvkey, l_shipdate AS d
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fund AS (SELECT o_custkey AS gvkey, o_orderkey AS report_id, o_orderdate + INTERVAL 45 DAY AS rdq,
                o_totalprice AS report_value FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
SELECT p.l_orderkey, p.l_linenumber, f.report_id, f.report_value
FROM prices p ASOF LEFT JOIN fund f ON p.gvkey = f.gvkey AND p.d >= f.rdq""")
def fundamentals_prices(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    prices = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("gvkey"), F.col("l_shipdate").alias("d"))
    fund = o.select(F.col("o_custkey").alias("gvkey"), F.col("o_orderkey").alias("report_id"),
                    (F.col("o_orderdate") + F.expr("interval 45 days")).alias("rdq"),
                    F.col("o_totalprice").alias("report_value"))
    # one report per (firm, report date): the latest filing wins
    fund = keep_one(fund, ["gvkey", "rdq"], [-F.col("report_id")])
    j = A.asof_join(prices, fund, ["gvkey"], "d", "rdq", ["report_id", "report_value"], tie_break=["report_id"])
    return j.select("l_orderkey", "l_linenumber", "report_id", "report_value")


# --- returns ------------------------------------------------------------------------------
@query("prev_price", ops="W8 P10 F19", sql="""
SELECT user_id, event_id, value, lag(value) OVER w AS prev_value, value / NULLIF(lag(value) OVER w, 0) - 1 AS ret_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def prev_price(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = P.lagged(e, ["user_id"], "ts", "value", tie_break=["event_id"])
    # one IEEE division in both engines: exact, so not rounded (rounding would meet ties on price ratios)
    return out.select("user_id", "event_id", "value", "prev_value", "ret_value")


@query("cumulative_return", ops="W9", sql="""
WITH r AS (SELECT user_id, event_id, ts, value / NULLIF(lag(value) OVER (PARTITION BY user_id ORDER BY ts), 0) - 1 AS ret
           FROM events),
s AS (SELECT *, sum(CASE WHEN ret > -1 THEN ln(1 + ret) END) OVER w AS lsum,
             count(*) FILTER (WHERE ret <= -1) OVER w AS wiped,
             count(*) FILTER (WHERE ret IS NULL) OVER w AS n_missing
      FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING))
SELECT user_id, event_id, ret,
       round(CASE WHEN wiped > 0 THEN -1.0 ELSE exp(lsum) - 1 END, 4) AS cum_ret, n_missing
FROM s""")
def cumulative_return(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    r = P.lagged(e, ["user_id"], "ts", "value", tie_break=["event_id"]).withColumnRenamed("ret_value", "ret")
    out = P.cumulative_return(r, ["user_id"], "ts", "ret", tie_break=["event_id"])
    return out.select("user_id", "event_id", "ret", F.round("cum_ret", 4).alias("cum_ret"),
                      F.col("n_missing").cast("long").alias("n_missing"))


@query("index_returns", ops="T10 F20", sql="""
SELECT CAST(l_shipdate AS DATE) AS date,
       round(sum(l_quantity * (l_discount * 0.7071067811865476)) / sum(l_quantity), 6) AS vwret,
       round(avg(l_discount * 0.7071067811865476), 6) AS ewret, count(l_discount) AS n
FROM lineitem GROUP BY 1""")
def index_returns(spark, sf):
    # returns scaled by 1/sqrt(2) so that no average sits exactly on a rounding tie
    li = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"),
                                             (F.col("l_discount") * F.lit(0.7071067811865476)).alias("ret"),
                                             F.col("l_quantity").alias("w"))
    return P.index_returns(li, "date", "ret", "w")


@query("distribution_rollup", ops="T11", sql="""
SELECT l_partkey AS PERMNO, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum(CAST(l_tax * 10 AS DECIMAL(18,4))) AS DOUBLE) AS total_amount,
       count(*) AS n_distributions, max(CAST(l_shipdate AS DATE)) AS last_ex_date
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2""")
def distribution_rollup(spark, sf):
    d = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("PERMNO"), "l_shipdate", (F.col("l_tax") * 10).alias("amt"))
    return P.distribution_rollup(d, ["PERMNO"], "l_shipdate", "amt")


@query("segment_totals", ops="T12", sql="""
WITH s AS (SELECT l_orderkey AS gvkey, count(*) AS n_segments,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS seg FROM lineitem GROUP BY 1)
SELECT s.gvkey, n_segments, CAST(seg AS DOUBLE) AS segment_total,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS firm_total,
       round(CAST(seg - CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), 2) AS diff
FROM s LEFT JOIN orders ON o_orderkey = s.gvkey""")
def segment_totals(spark, sf):
    seg = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("gvkey"), "l_extendedprice")
    firm = table(spark, sf, "orders").select(F.col("o_orderkey").alias("gvkey"), "o_totalprice")
    return P.segment_totals(seg, firm, ["gvkey"], "l_extendedprice", "o_totalprice")


# --- option chain, curve, Greeks ------------------------------------------------------------
CHAIN = DerivedFrame("chain", "lineitem", (
    ("optionid", "l_orderkey * 10 + l_linenumber"),
    ("secid", "l_suppkey"),
    ("date", "cast(l_shipdate as date)"),
    ("dte", "30 * l_linenumber"),
    ("exdate", "date_add(cast(l_shipdate as date), 30 * l_linenumber)"),
    ("cp_flag", "case when l_returnflag = 'A' then 'C' when l_returnflag = 'R' then 'P' "
                "when l_linestatus = 'O' then 'C' else 'P' end"),
    ("strike_price", "cast(l_linenumber as bigint) * 1000 + 50000"),
    ("best_bid", "l_extendedprice / l_quantity / 40.0"),
    ("best_offer", "l_extendedprice / l_quantity / 40.0 + l_tax + 0.05"),
    ("forward_price", "l_extendedprice / l_quantity / 20.0"),
    ("impl_volatility", "case when l_linenumber = 7 then null else 0.1 + 2 * l_discount end"),
))
CURVE = DerivedFrame("curve", "orders", (
    ("date", "cast(o_orderdate as date)"),
    ("days", "60 * cast(substr(o_orderpriority, 1, 1) as int)"),
    ("rate", "min(o_totalprice) / 100000.0")),
    group_by=("date", "days"))


@query("option_features", ops="T13 F14", sql=with_ctes(CHAIN, body="""
SELECT optionid, (best_bid + best_offer) / 2.0 AS mid, best_offer - best_bid AS spread,
       strike_price / 1000.0 AS strike, (strike_price / 1000.0) / forward_price AS moneyness,
       CAST(datediff('day', date, exdate) AS INTEGER) AS dte
FROM chain"""))
def option_features(spark, sf):
    ch = P.option_features(CHAIN.frame(spark, sf).withColumnRenamed("dte", "_dte"), underlying="forward_price")
    return ch.select("optionid", "mid", "spread", "strike", "moneyness", "dte")


@query("chain_pairs", ops="T13 W1", sql=with_ctes(CHAIN, extra="""
one AS (SELECT *, (best_bid + best_offer) / 2.0 AS mid,
               row_number() OVER (PARTITION BY secid, date, exdate, strike_price, cp_flag
                                  ORDER BY optionid, best_bid, best_offer) AS rn FROM chain)""", body="""
SELECT c.secid, c.date, c.exdate, c.strike_price, c.mid AS call_mid, p.mid AS put_mid
FROM (SELECT * FROM one WHERE rn = 1 AND cp_flag = 'C') c
JOIN (SELECT * FROM one WHERE rn = 1 AND cp_flag = 'P') p USING (secid, date, exdate, strike_price)"""))
def chain_pairs(spark, sf):
    ch = P.option_features(CHAIN.frame(spark, sf).withColumnRenamed("dte", "_dte"), underlying="forward_price")
    # optionid repeats (lineitem has duplicate keys): bid and offer complete the order
    return P.call_put_pairs(ch, order=["optionid", "best_bid", "best_offer"])


_RATE_SQL = """
lo AS (SELECT c.*, z.days AS lo_days, z.rate AS lo_rate FROM chain c
       ASOF LEFT JOIN curve z ON c.date = z.date AND c.dte >= z.days),
hl AS (SELECT l.*, z.days AS hi_days, z.rate AS hi_rate FROM lo l
       ASOF LEFT JOIN curve z ON l.date = z.date AND l.dte <= z.days),
rated AS (SELECT *, CASE WHEN lo_days IS NULL THEN hi_rate WHEN hi_days IS NULL OR hi_days = lo_days THEN lo_rate
                     ELSE lo_rate + (hi_rate - lo_rate) * (dte - lo_days) / (hi_days - lo_days) END AS rate FROM hl)"""


def _rated(spark, sf):
    return C.curve_rate(CHAIN.frame(spark, sf), CURVE.frame(spark, sf))


@query("curve_rate", ops="J21", sql=with_ctes(CHAIN, CURVE, extra=_RATE_SQL, body="""
SELECT optionid, date, dte, rate FROM rated"""))
def curve_rate(spark, sf):
    return _rated(spark, sf).select("optionid", "date", "dte", "rate")


def _ncdf_sql(x: str) -> str:
    # same published polynomial as the Spark expression (see functions.scalars.norm_cdf)
    t = f"(1.0 / (1.0 + 0.2316419 * abs({x})))"
    poly = (f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * "
            f"(-1.821255978 + {t} * 1.330274429)))))")
    up = f"(1.0 - exp(-abs({x}) * abs({x}) / 2.0) / 2.5066282746310002 * {poly})"
    return f"(CASE WHEN {x} >= 0 THEN {up} ELSE 1.0 - {up} END)"


def _greeks_sql() -> str:
    d1 = "((ln(forward_price / strike) + 0.5 * impl_volatility * impl_volatility * t) / (impl_volatility * sqrt(t)))"
    d2 = f"({d1} - impl_volatility * sqrt(t))"
    disc = "exp(-r * t)"
    pdf = f"(exp(-{d1} * {d1} / 2.0) / 2.5066282746310002)"
    delta = (f"CASE WHEN cp_flag = 'C' THEN {disc} * {_ncdf_sql(d1)} "
             f"ELSE {disc} * ({_ncdf_sql(d1)} - 1.0) END")
    gamma = f"{disc} * {pdf} / (forward_price * (impl_volatility * sqrt(t)))"
    vega = f"forward_price * {disc} * {pdf} * sqrt(t)"
    decay = f"-forward_price * {disc} * {pdf} * impl_volatility / (2.0 * sqrt(t))"
    theta = (f"CASE WHEN cp_flag = 'C' THEN {decay} + r * forward_price * {disc} * {_ncdf_sql(d1)} "
             f"- r * strike * {disc} * {_ncdf_sql(d2)} ELSE {decay} - r * forward_price * {disc} * "
             f"{_ncdf_sql('(-' + d1 + ')')} + r * strike * {disc} * {_ncdf_sql('(-' + d2 + ')')} END")
    return (f"SELECT optionid, round({delta}, 6) AS bs_delta, round({gamma}, 6) AS bs_gamma, "
            f"round({vega}, 6) AS bs_vega, round({theta}, 6) AS bs_theta "
            f"FROM (SELECT *, strike_price / 1000.0 AS strike, dte / 365.0 AS t, rate / 100.0 AS r FROM rated) "
            f"WHERE impl_volatility IS NOT NULL AND rate IS NOT NULL")


@query("greeks", ops="T14 F21 J21", sql=with_ctes(CHAIN, CURVE, extra=_RATE_SQL, body=_greeks_sql()))
def greeks(spark, sf):
    r = _rated(spark, sf).where(F.col("impl_volatility").isNotNull() & F.col("rate").isNotNull())
    r = r.withColumns({"strike": S.strike("strike_price"), "t": F.col("dte") / 365.0, "r": F.col("rate") / 100.0})
    g = C.greeks(r)
    return g.select("optionid", *[F.round(c, 6).alias(c) for c in ("bs_delta", "bs_gamma", "bs_vega", "bs_theta")])


# --- scalar functions on derived text -------------------------------------------------------
CODES = DerivedFrame("codes", "events", (
    ("event_id", "event_id"),
    ("ric", "concat('SDA', substr('FGHJKMNQUVXZ', cast(1 + user_id % 12 as int), 1), "
            "cast(20 + user_id % 10 as string), case when user_id < 50 then '^2' else '' end)"),
    ("cds", "concat('T', cast(user_id as string), cast(1 + user_id % 10 as string), 'Y', 'US', 'SN', '=', 'MP')"),
    ("analyst", "cast(user_id * 7 as string)"),
    ("cusip", "concat(' ', lower(substr(md5(cast(user_id as string)), 1, 9)), ' ')"),
    ("divyield", "case when event_type = 'error' then '' when value < 10 then concat('.', cast(cast(floor(value * 100) as bigint) as string), '%') "
                 "else concat(cast(value as string), '%') end"),
    ("d", "cast(ts as date)"),
    ("tm", "lpad(cast(event_id % 24 as string), 2, '0') || ':30:00'"),
))


@query("parse_codes", ops="F15 F16 F17 F18 P14 F8", sql=with_ctes(CODES, body="""
SELECT event_id,
       regexp_extract(upper(trim(ric)), '^([A-Z0-9]*?[A-Z]+)([FGHJKMNQUVXZ])(\\d{1,2})(?:\\^(\\d))?$', 1) AS root,
       regexp_extract(upper(trim(ric)), '^([A-Z0-9]*?[A-Z]+)([FGHJKMNQUVXZ])(\\d{1,2})(?:\\^(\\d))?$', 2) AS month_code,
       regexp_extract(upper(trim(ric)), '^([A-Z0-9]*?[A-Z]+)([FGHJKMNQUVXZ])(\\d{1,2})(?:\\^(\\d))?$', 3) AS year_digits,
       nullif(regexp_extract(upper(trim(ric)), '^([A-Z0-9]*?[A-Z]+)([FGHJKMNQUVXZ])(\\d{1,2})(?:\\^(\\d))?$', 4), '') AS decade_flag,
       nullif(regexp_extract(upper(trim(cds)), '^([A-Z0-9]+?)(\\d+[YM])([A-Z]{2})([A-Z]{2})=([A-Z0-9]+)$', 2), '') AS tenor,
       lpad(trim(analyst), 6, '0') AS analyst6,
       substr(upper(trim(cusip)), 1, 8) AS cusip8
FROM codes"""))
def parse_codes(spark, sf):
    c = CODES.frame(spark, sf)
    v = S.vendor_code_parts("ric")
    cds = S.cds_code_parts("cds")
    return c.select("event_id", v["root"].alias("root"), v["month_code"].alias("month_code"),
                    v["year_digits"].alias("year_digits"), v["decade_flag"].alias("decade_flag"),
                    cds["tenor"].alias("tenor"), S.zero_pad("analyst", 6).alias("analyst6"),
                    S.cusip8("cusip").alias("cusip8"))


@query("pct_to_double", ops="F11", sql=with_ctes(CODES, body="""
SELECT event_id, TRY_CAST(regexp_replace(trim(divyield), '%$', '') AS DOUBLE) / 100.0 AS divyield_num FROM codes"""))
def pct_to_double(spark, sf):
    return CODES.frame(spark, sf).select("event_id", S.pct_to_double("divyield").alias("divyield_num"))


@query("ts_from_parts", ops="F12 F13 F9", sql=with_ctes(CODES, body="""
SELECT event_id, strftime(CAST(d AS TIMESTAMP) + CAST(tm AS INTERVAL), '%Y-%m-%d %H:%M:%S') AS stamp,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS yyyymmdd,
       CAST(strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) = d AS roundtrip_ok
FROM codes"""))
def ts_from_parts(spark, sf):
    c = CODES.frame(spark, sf)
    ymd = S.date_to_yyyymmdd("d")
    return c.select("event_id", F.date_format(S.ts_from_parts("d", "tm"), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                    ymd.alias("yyyymmdd"), (S.yyyymmdd_to_date(ymd) == F.col("d")).alias("roundtrip_ok"))


FILES = DerivedFrame("files", "orders", (
    ("o_orderkey", "o_orderkey"),
    ("fname", "concat('unadjusted history ', case when o_orderstatus = 'F' then 'actdats ' else '' end, "
              "cast(year(o_orderdate) as string), ' -', lpad(cast(month(o_orderdate) as string), 2, '0'), "
              "' to  ', cast(year(o_orderdate) + 1 as string), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '.csv')"),
))


@query("parse_filename", ops="F10 S25", sql=with_ctes(FILES, body="""
SELECT o_orderkey,
  CAST(strptime(regexp_extract(fname, '(\\d{4})\\s*-\\s*(\\d{2})\\s+to\\s+(\\d{4})\\s*-\\s*(\\d{2})', 1) || '-' ||
       regexp_extract(fname, '(\\d{4})\\s*-\\s*(\\d{2})\\s+to\\s+(\\d{4})\\s*-\\s*(\\d{2})', 2) || '-01', '%Y-%m-%d') AS DATE) AS start,
  last_day(CAST(strptime(regexp_extract(fname, '(\\d{4})\\s*-\\s*(\\d{2})\\s+to\\s+(\\d{4})\\s*-\\s*(\\d{2})', 3) || '-' ||
       regexp_extract(fname, '(\\d{4})\\s*-\\s*(\\d{2})\\s+to\\s+(\\d{4})\\s*-\\s*(\\d{2})', 4) || '-01', '%Y-%m-%d') AS DATE)) AS "end",
  CASE WHEN contains(lower(fname), 'actdats') THEN 'ACTDATS' ELSE 'ANNDATS' END AS filter_col
FROM files"""))
def parse_filename(spark, sf):
    f = FILES.frame(spark, sf)
    start, end, dim = S.filename_range(F.col("fname"))
    return f.select("o_orderkey", start.alias("start"), end.alias("end"), dim.alias("filter_col"))


# --- daily security panel: one row per (part, ship day) ---------------------------------------
DAILY = DerivedFrame("daily", "lineitem", (
    ("PERMNO", "l_partkey"),
    ("date", "cast(l_shipdate as date)"),
    # returns scaled by 1/sqrt(2): averages of hundredths would sit exactly on rounding ties
    ("ret", "(min(l_discount) - 0.05) * 0.7071067811865476"),
    ("cap", "cast(sum(cast(l_extendedprice as decimal(18,2))) as double)")),
    group_by=("PERMNO", "date"))


@query("index_returns_lagged_cap", ops="T10 W8", sql=with_ctes(DAILY, extra="""
w AS (SELECT *, lag(cap) OVER (PARTITION BY PERMNO ORDER BY date) AS w FROM daily)""", body="""
SELECT date, round(sum(w * ret) / sum(CASE WHEN ret IS NOT NULL THEN w END), 6) AS vwret,
       round(avg(ret), 6) AS ewret, count(ret) AS n
FROM w GROUP BY date"""))
def index_returns_lagged_cap(spark, sf):
    return P.index_returns(DAILY.frame(spark, sf), "date", "ret", "cap", lag_by=["PERMNO"])


@query("distribution_prices", ops="T11", sql=with_ctes(DAILY, body="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS PERMNO, CAST(l.l_shipdate AS DATE) AS DisExDt, d.cap AS price
FROM lineitem l LEFT JOIN daily d ON d.PERMNO = l.l_partkey AND d.date = CAST(l.l_shipdate AS DATE)
WHERE l.l_returnflag = 'R'"""))
def distribution_prices(spark, sf):
    dist = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("PERMNO"), F.col("l_shipdate").cast("date").alias("DisExDt"))
    prices = DAILY.frame(spark, sf).withColumnRenamed("cap", "price")
    return P.distribution_prices(dist, prices, ["PERMNO"], "DisExDt", "date", ["price"])


@query("id_lookup", ops="J20", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand, p.p_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def id_lookup(spark, sf):
    """Security id on the fact → the other vendor's attributes through a lookup table."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    lookup = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return P.enrich(li, lookup, ["l_partkey"])


# --- annual and monthly updates, price kinds and caps, dated membership -----------------------
@query("union_annual_monthly", ops="U4 U3 W1", sql=with_ctes(OLD, NEW, extra="""
a AS (SELECT PERMNO, date AS DlyCalDt, PRC AS DlyPrc, VOL AS DlyVol FROM old
      QUALIFY row_number() OVER (PARTITION BY PERMNO, date ORDER BY VOL DESC, PRC DESC) = 1),
m AS (SELECT PERMNO, DlyCalDt, DlyPrc, DlyVol FROM new
      QUALIFY row_number() OVER (PARTITION BY PERMNO, DlyCalDt ORDER BY DlyVol DESC, DlyPrc DESC) = 1)""", body="""
SELECT *, 'new' AS source FROM m UNION ALL
SELECT *, 'old' FROM a WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.PERMNO = a.PERMNO AND m.DlyCalDt = a.DlyCalDt)"""))
def union_annual_monthly(spark, sf):
    """An annual file (old) and monthly updates (new): one row a security and day in each, the update before the annual row."""
    old, new = OLD.frame(spark, sf).drop("CFACPR"), NEW.frame(spark, sf).drop("DlyFacPrc")
    return P.union_formats(old, new, {"date": "DlyCalDt", "PRC": "DlyPrc", "VOL": "DlyVol"}, ["PERMNO", "DlyCalDt"], latest=["DlyVol", "DlyPrc"])


QUOTES = DerivedFrame("quotes", "lineitem", (
    ("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"),
    ("prc", "case when l_linenumber = 6 then null when l_linenumber = 5 then 0.0 when l_linenumber = 4 then -l_extendedprice else l_extendedprice end"),
    ("flg", "case when l_returnflag = 'R' then 'BA' else 'TR' end"), ("shr", "l_quantity"),
    ("cap", "case when l_returnflag = 'A' then l_extendedprice * l_quantity + 1000.0 else l_extendedprice * l_quantity end")))


@query("price_kinds_and_caps", ops="F19 F20", sql=with_ctes(QUOTES, body="""
SELECT l_orderkey, l_linenumber, prc, CASE WHEN prc IS NULL OR prc = 0 THEN 'missing' WHEN prc < 0 OR flg = 'BA' THEN 'quote' ELSE 'trade' END AS kind,
       CASE WHEN abs(prc) > 0 THEN abs(prc) * shr END AS mkt_cap,
       abs(CASE WHEN abs(prc) > 0 THEN abs(prc) * shr END - cap) <= 1e-6 * greatest(abs(prc) * shr, 1.0) AS cap_ok
FROM quotes"""))
def price_kinds_and_caps(spark, sf):
    price, kind = S.price_and_flag("prc", "flg")
    return QUOTES.frame(spark, sf).select("l_orderkey", "l_linenumber", price.alias("prc"), kind.alias("kind"), S.market_cap("prc", "shr").alias("mkt_cap"),
                                          S.cap_matches("prc", "shr", "cap").alias("cap_ok"))


MEMBERS = DerivedFrame("members", "part", (
    ("PERMNO", "p_partkey"), ("start", "date_add(cast('1994-01-01' as date), cast(p_partkey % 1500 as int))"),
    ("ending", "case when p_partkey % 4 = 0 then null else date_add(cast('1996-01-01' as date), cast(p_partkey % 1300 as int)) end")))


@query("index_panel_compared", ops="T10 J12 W8", sql=with_ctes(DAILY, MEMBERS, extra="""
w AS (SELECT *, lag(cap) OVER (PARTITION BY PERMNO ORDER BY date) AS w FROM daily),
ours AS (SELECT date, round(sum(w * ret) / sum(CASE WHEN ret IS NOT NULL THEN w END), 6) AS vwret, round(avg(ret), 6) AS ewret FROM w
         WHERE EXISTS (SELECT 1 FROM members m WHERE m.PERMNO = w.PERMNO AND w.date >= m.start AND w.date <= coalesce(m.ending, DATE '9999-12-31')) GROUP BY date),
stored AS (SELECT date, round(avg(ret), 6) AS ewretd FROM daily WHERE day(date) <> 3 GROUP BY date)""", body="""
SELECT coalesce(o.date, s.date) AS date, o.ewret AS computed, s.ewretd AS stored,
       CASE WHEN s.ewretd IS NULL THEN 'not stored' WHEN o.ewret IS NULL THEN 'not computed' WHEN abs(o.ewret - s.ewretd) <= 1e-6 THEN 'same'
            WHEN abs(o.ewret - s.ewretd) <= 0.01 THEN 'close' ELSE 'off' END AS "class"
FROM ours o FULL JOIN stored s ON o.date = s.date"""))
def index_panel_compared(spark, sf):
    """Mean returns over each day's members against stored ones (here: over all securities, some days absent)."""
    daily = DAILY.frame(spark, sf)
    ours = P.index_panel(daily, MEMBERS.frame(spark, sf), ["PERMNO"], "date", "ret", "cap", "start", "ending", lag_by=["PERMNO"])
    stored = daily.where(F.dayofmonth("date") != 3).groupBy("date").agg(F.round(F.avg("ret"), 6).alias("ewretd"))
    return P.compare_returns(ours, stored, "date", "ewret", "ewretd", close=0.01)
