"""Column expressions for the vendor-data rules (sentinels, codes, dates).

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.  ANSI mode is on in Spark 4, so parsing always
goes through ``try_*`` forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Letter codes that vendors put into numeric return columns.
RETURN_CODES = ("B", "C")          # RET / RETX: no previous / no current price
DELIST_CODES = ("A", "S")          # DLRET / DLRETX
SIC_MISSING = "Z"                  # SICCD not available
LINK_OPEN_VALUES = ("", "E")       # LINKENDDT: still active
MISSING_CODES = ("", "000000")     # analyst / estimator not given
VALUE_SENTINEL = -99999.0          # estimate VALUE sentinel
VALUE_LIMIT = 1e12                 # abs(VALUE) above this is suspect
ZERO_DATE = "1970-01-01"           # missing non-null date lands here
OPEN_END_DATE = "9999-12-31"       # rendering of an open interval end
# Date layouts accepted by the best-effort parser, tried in this order.
DATE_PATTERNS = ("yyyy-MM-dd", "yyyyMMdd", "M/d/yyyy", "yyyy/MM/dd", "d-MMM-yyyy", "dd.MM.yyyy")
# Strict decimal literal: optional sign, digits with optional fraction, optional exponent.
NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_RE = r"^\s*[+-]?\d+\s*$"
# ----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """``empty(s)``: NULL-safe test for an empty string."""
    return F.coalesce(F.length(_c(c)) == 0, F.lit(False))


def is_missing_code(c, codes: Sequence[str] = MISSING_CODES) -> Column:
    """Analyst/estimator placeholder: empty or all zeros."""
    return F.coalesce(_c(c).isin(*codes), F.lit(False))


def is_zero_date(c) -> Column:
    return F.coalesce(_c(c) == F.lit(ZERO_DATE).cast("date"), F.lit(False))


def to_double_or_null(c) -> Column:
    """``toFloat64OrNull``: strict numeric text → double, anything else NULL.

    Spark's cast accepts Java suffixes (``5F``, ``1d``) and ``NaN``; the
    regex guard rejects those so a code never turns into a number.
    """
    s = _c(c).cast("string")
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def to_long_or_null(c) -> Column:
    s = _c(c).cast("string")
    return F.when(s.rlike(INTEGER_RE), s.try_cast("long"))


def split_code(c) -> Column:
    """The non-numeric text of a coded numeric column (trimmed), else NULL."""
    s = _c(c).cast("string")
    non_numeric = s.isNotNull() & (F.length(s) > 0) & ~s.rlike(NUMERIC_RE)
    return F.when(non_numeric, F.trim(s))


def pct_to_double(c) -> Column:
    """``'.769%'`` → 0.00769; empty or unparseable → NULL."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), "%$", "")
    return to_double_or_null(s) / F.lit(100.0)


def parse_date(c, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Best-effort date parsing over a fixed list of layouts.

    A bare ``cast(... as date)`` is never used: it reads ``'2020'`` as
    2020-01-01.  ``try_to_date`` with explicit layouts is NULL on failure.
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_date(s, p) for p in patterns])


def yyyymmdd_to_date(c) -> Column:
    """Integer ``YYYYMMDD`` → date (NULL if not a real calendar day)."""
    return F.try_to_date(F.lpad(_c(c).cast("string"), 8, "0"), "yyyyMMdd")


def date_to_yyyymmdd(c) -> Column:
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def ts_from_parts(d, t) -> Column:
    """Date + ``HH:MM:SS`` string → ``timestamp_ntz`` (no zone conversion)."""
    s = F.concat_ws(" ", F.date_format(_c(d), "yyyy-MM-dd"), F.coalesce(_c(t), F.lit("00:00:00")))
    return F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def link_end(c, open_values: Sequence[str] = LINK_OPEN_VALUES, open_date: str = OPEN_END_DATE) -> Column:
    """``LINKENDDT``-style end: open markers and NULL → far future, else a date.

    Unparseable text stays NULL (and is a reject at ingest), never open.
    """
    s = F.trim(_c(c).cast("string"))
    return F.when(s.isNull() | s.isin(*open_values), F.lit(open_date).cast("date")) \
        .otherwise(parse_date(s))


def is_open_end(c, open_values: Sequence[str] = LINK_OPEN_VALUES) -> Column:
    """Active-link predicate; NULL counts as active (unlike ``= ''``)."""
    s = _c(c).cast("string")
    return s.isNull() | F.trim(s).isin(*open_values)


def negative_to_null(c) -> Column:
    """Negative sentinel in an id column → NULL (clean views only)."""
    return F.when(_c(c) >= 0, _c(c))


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(_c(c)), _c(c))


def zero_pad(c, width: int) -> Column:
    """Zero-pad a code (analyst 6 digits, gvkey 6)."""
    return F.lpad(F.trim(_c(c).cast("string")), width, "0")


def norm_id(c) -> Column:
    """Trim + upper an identifier."""
    return F.upper(F.trim(_c(c).cast("string")))


def cusip8(c) -> Column:
    """9-character CUSIP → 8-character issue id (drop check digit)."""
    return F.substring(norm_id(c), 1, 8)


def strike(c) -> Column:
    """Vendor strike is price × 1000."""
    return _c(c) / F.lit(1000.0)


def year_range(date_col, year: int) -> Column:
    """``toYear(d) = Y`` in the form that Parquet pushdown understands."""
    return (_c(date_col) >= F.lit(f"{year:04d}-01-01").cast("date")) & \
           (_c(date_col) < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def date_range(date_col, start: str, end: str) -> Column:
    """Closed date range ``BETWEEN start AND end``."""
    return _c(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


# File names such as "unadjusted history 2019 -01 to  2019-06.csv" carry the
# range (stray spaces tolerated); "actdats" marks the legacy filter column.
FILENAME_RANGE_RE = r"(\d{4})\s*-\s*(\d{2})\s+to\s+(\d{4})\s*-\s*(\d{2})"


def filename_range(path_col) -> tuple[Column, Column, Column]:
    """(start month date, end month date, filter column) from a chunk file name."""
    p = _c(path_col)
    start = F.try_to_date(F.concat_ws("-", F.regexp_extract(p, FILENAME_RANGE_RE, 1),
                                      F.regexp_extract(p, FILENAME_RANGE_RE, 2), F.lit("01")),
                          "yyyy-MM-dd")
    end = F.try_to_date(F.concat_ws("-", F.regexp_extract(p, FILENAME_RANGE_RE, 3),
                                    F.regexp_extract(p, FILENAME_RANGE_RE, 4), F.lit("01")),
                        "yyyy-MM-dd")
    dim = F.when(F.lower(p).contains("actdats"), F.lit("ACTDATS")).otherwise(F.lit("ANNDATS"))
    return start, F.last_day(end), dim


# Futures vendor codes: root, month letter, 1-2 year digits, optional ^decade.
VENDOR_CODE_RE = r"^([A-Z0-9]*?[A-Z]+)([FGHJKMNQUVXZ])(\d{1,2})(?:\^(\d))?$"


def vendor_code_parts(c) -> dict[str, Column]:
    """Split a futures code such as ``SDAZ24^2`` into its parts."""
    s = norm_id(c)
    return {
        "root": F.regexp_extract(s, VENDOR_CODE_RE, 1),
        "month_code": F.regexp_extract(s, VENDOR_CODE_RE, 2),
        "year_digits": F.regexp_extract(s, VENDOR_CODE_RE, 3),
        "decade_flag": F.nullif(F.regexp_extract(s, VENDOR_CODE_RE, 4), F.lit("")),
    }


# CDS codes: {TICKER}{TENOR}{REGION}{TYPE}={SOURCE}
CDS_CODE_RE = r"^([A-Z0-9]+?)(\d+[YM])([A-Z]{2})([A-Z]{2})=([A-Z0-9]+)$"


def cds_code_parts(c) -> dict[str, Column]:
    s = norm_id(c)
    names = ("ticker", "tenor", "region", "doc_type", "source")
    return {n: F.nullif(F.regexp_extract(s, CDS_CODE_RE, i + 1), F.lit("")) for i, n in enumerate(names)}


def norm_cdf(x) -> Column:
    """Standard normal CDF (Abramowitz–Stegun 26.2.17, |error| < 7.5e-8).

    Spark has no ``erf``; this polynomial keeps the Greeks JVM-side.
    """
    x = _c(x)
    tail = cdf_tail(cdf_t(x), norm_pdf(x))
    return F.when(x >= 0, F.lit(1.0) - tail).otherwise(tail)


# fixed values: coefficients of the published approximation
_CDF_P = 0.2316419
_CDF_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def cdf_t(x) -> Column:
    """First step of ``norm_cdf``; keep it as a column of its own where the CDF is part of a larger expression."""
    return F.lit(1.0) / (F.lit(1.0) + F.lit(_CDF_P) * F.abs(_c(x)))


def cdf_tail(t, pdf) -> Column:
    """N(-|x|) from ``cdf_t(x)`` and ``norm_pdf(x)``."""
    t, (b1, b2, b3, b4, b5) = _c(t), (F.lit(b) for b in _CDF_B)
    return _c(pdf) * (t * (b1 + t * (b2 + t * (b3 + t * (b4 + t * b5)))))


def norm_pdf(x) -> Column:
    x = _c(x)
    return F.exp(-x * x / 2.0) / F.lit(2.5066282746310002)


def periodicity_1char(c) -> Column:
    """Periodicity as one letter: the actuals tables write ``ANN``/``QTR``/``SAN``,
    the stop tables ``A``/``Q``/``S``; the first letter is the common key."""
    return F.upper(F.substring(F.trim(_c(c).cast("string")), 1, 1))


def price_and_flag(price, flag) -> tuple[Column, Column]:
    """(price, kind): the price as it is, and what it is: ``trade``, ``quote`` (a flagged or negative price, the
    mean of bid and offer), ``missing`` (NULL or zero).  Neither overwrites the other.
    """
    p, f = _c(price), F.upper(F.trim(_c(flag).cast("string")))
    kind = F.when(p.isNull() | (p == 0), F.lit("missing")).when((p < 0) | (f == "BA"), F.lit("quote")).otherwise(F.lit("trade"))
    return p, kind


def market_cap(price, shares) -> Column:
    """price × shares; the sign that marks a quote is no part of the price.  NULL where either is missing or the price is zero."""
    p = F.abs(_c(price))
    return F.when(p > 0, p * _c(shares))


def cap_matches(price, shares, stored, tol: float = 1e-6) -> Column:
    """whether the stored cap is the computed one, to a share ``tol`` of it (NULL where either is unknown)."""
    cap = market_cap(price, shares)
    return F.abs(cap - _c(stored)) <= F.lit(tol) * F.greatest(F.abs(cap), F.lit(1.0))
