"""Scalar rules: strict numbers, codes, percent strings, open link ends, dates, normal CDF."""

import math

from pyspark.sql import functions as F

from quantlake.functions import scalars as S


def _one(spark, col, values, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {t}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_strict_numeric(spark):
    assert _one(spark, S.to_double_or_null, ["1.5", "5F", "1d", "NaN", "", "B", "-2e3", " 3 "]) == \
        [1.5, None, None, None, None, None, -2000.0, 3.0]


def test_split_code_and_pct(spark):
    assert _one(spark, S.split_code, ["0.1", "B", "", None, "5F"]) == [None, "B", None, None, "5F"]
    assert _one(spark, S.pct_to_double, [".769%", "12.5%", "", "x%"]) == [0.00769, 0.125, None, None]


def test_link_end_and_open(spark):
    out = _one(spark, S.link_end, ["E", "", None, "2020-05-01", "garbage"])
    assert [str(x) if x else None for x in out] == ["9999-12-31", "9999-12-31", "9999-12-31", "2020-05-01", None]
    assert _one(spark, S.is_open_end, ["E", "", None, "2020-01-01"]) == [True, True, True, False]


def test_dates(spark):
    out = _one(spark, S.parse_date, ["2020-01-02", "20200103", "1/4/2020", "2020", "E"])
    assert [str(x) if x else None for x in out] == ["2020-01-02", "2020-01-03", "2020-01-04", None, None]
    assert [str(x) for x in _one(spark, S.yyyymmdd_to_date, [20200229], "int")] == ["2020-02-29"]
    assert _one(spark, S.yyyymmdd_to_date, [20190229], "int") == [None]


def test_norm_cdf(spark):
    xs = [-3.0, -1.0, -0.1, 0.0, 0.5, 2.0]
    got = _one(spark, S.norm_cdf, xs, "double")
    for x, g in zip(xs, got):
        assert abs(g - 0.5 * (1 + math.erf(x / math.sqrt(2)))) < 1e-7


def test_vendor_codes(spark):
    df = spark.createDataFrame([("SDAZ24^2",), ("SDAZ3^2",), ("sdaz26",)], "c string")
    p = S.vendor_code_parts("c")
    rows = df.select(p["root"], p["month_code"], p["year_digits"], p["decade_flag"]).collect()
    assert [tuple(r) for r in rows] == [("SDA", "Z", "24", "2"), ("SDA", "Z", "3", "2"), ("SDA", "Z", "26", None)]


def test_greeks_known_values_and_qc(spark):
    from quantlake.operators.curve import greeks, greeks_qc
    phi = math.exp(-0.1 ** 2 / 2) / math.sqrt(2 * math.pi)          # pdf at d1 = 0.1
    n = 0.5 * (1 + math.erf(0.1 / math.sqrt(2)))
    df = spark.createDataFrame([("C", 100.0, 100.0, 1.0, 0.2, 0.0, n, 0.9), ("P", 100.0, 100.0, 1.0, 0.2, 0.0, n - 1, 0.0),
                                ("C", 100.0, 100.0, 1.0, None, 0.0, None, None)],
                               "cp_flag string, forward_price double, strike double, t double, impl_volatility double, "
                               "r double, delta double, gamma double")
    rows = greeks(df).collect()
    assert abs(rows[0].bs_delta - n) < 1e-7 and abs(rows[1].bs_delta - (n - 1)) < 1e-7
    assert abs(rows[0].bs_gamma - phi / 20) < 1e-9 and abs(rows[0].bs_vega - 100 * phi) < 1e-6
    assert abs(rows[0].bs_theta - (-100 * phi * 0.2 / 2)) < 1e-6 and rows[2].bs_delta is None
    qc = greeks_qc(greeks(df), {"bs_delta": "delta", "bs_gamma": "gamma"}).collect()
    assert qc[0].delta_ok and not qc[0].gamma_ok and qc[1].gamma_ok


def test_split_coded_known_codes(spark):
    from quantlake.operators.quality import split_coded
    df = spark.createDataFrame([("0.1",), ("B",), ("5F",), ("",)], "RET string")
    rows = split_coded(df, "RET", ["B", "C"]).collect()
    assert [(r.RET_num, r.RET_code, r.RET_known) for r in rows] == \
        [(0.1, None, None), (None, "B", True), (None, "5F", False), (None, None, None)]
