"""Declared table specs: typed columns, nullability, keys, load budget.

A ``TableSpec`` is the single source for a table's ``StructType``, its sort
key (write layout), natural key (dedupe / promote) and the error budget of
its loader.  Column names are the vendors' header names, matched by name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "short": T.ShortType(),
    "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    comment: str = ""

    @property
    def spark_type(self) -> T.DataType:
        return _TYPES[self.type]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    sort_key: tuple[str, ...] = ()
    natural_key: tuple[str, ...] = ()
    budget_rows: int = 0          # bad rows allowed ...
    budget_ratio: float = 0.0     # ... and share allowed; the load fails only past both
    comment: str = ""
    date_patterns: tuple[str, ...] | None = None
    missing_date_default: str = "1970-01-01"
    extra: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable,
                                           {"comment": c.comment} if c.comment else {})
                             for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def spec(name: str, cols: str, **kw) -> TableSpec:
    """Compact declaration: ``"NAME:type[!] NAME2:type ..."`` (``!`` = NOT NULL)."""
    out = []
    for tok in cols.split():
        n, _, t = tok.partition(":")
        t = t or "string"
        out.append(ColumnSpec(n, t.rstrip("!"), nullable=not t.endswith("!")))
    return TableSpec(name, tuple(out), **kw)


# --- fixed values: declared tables ---------------------------------------------
# Column names are the vendors' CSV header names (matched by name at ingest) and
# must stay as written; types are the Spark types after ingest.
ESTIMATE_HISTORY = spec(
    "estimates.history",
    "TICKER:string! CUSIP:string! OFTIC:string! CNAME:string! ACTDATS:date! ESTIMATOR:string! ANALYS:string! CURRFL:string! "
    "PDF:string! FPI:string! MEASURE:string! VALUE:double CURR:string! FPEDATS:date! ACTTIMS:string! REVDATS:date! "
    "REVTIMS:string! ANNDATS:date! ANNTIMS:string! USFIRM:short! report_curr:string!",
    sort_key=("TICKER", "MEASURE", "FPI", "FPEDATS", "ACTDATS", "ESTIMATOR"),
    natural_key=("TICKER", "MEASURE", "FPI", "FPEDATS", "ESTIMATOR", "ANALYS", "ACTDATS", "ACTTIMS",
                 "ANNDATS", "ANNTIMS"),
    budget_rows=1000, budget_ratio=0.001,
    comment="analyst estimates; ACTDATS is the point-in-time stamp")

LINK = spec(
    "equity.firm_security_link",
    "gvkey:string! LINKPRIM LIID LINKTYPE LPERMNO:int! LINKDT:date LINKENDDT:string",
    sort_key=("gvkey", "LPERMNO"), budget_rows=100,
    comment="LINKENDDT 'E' or empty = still active")

SECURITY_NAMES = spec(
    "equity.security_names",
    "PERMNO:long! SecInfoStartDt:date! SecInfoEndDt:date Ticker IssuerNm",
    sort_key=("PERMNO", "SecInfoStartDt"), budget_rows=100)

CONSTITUENTS = spec(
    "equity.index_constituents",
    "INDNO:long PERMNO:long! MbrStartDt:date MbrEndDt:date DlyCalDt:date! DlyCap:double DlyRet:double",
    sort_key=("PERMNO", "DlyCalDt"), budget_rows=100)

DAILY_STOCK_OLD = spec(
    "equity.daily_stock_old",
    "PERMNO:long! date:date! SICCD PRC:double VOL:long RET RETX DLRET DLRETX CFACPR:double",
    sort_key=("PERMNO", "date"), budget_rows=100,
    comment="RET/RETX carry B/C codes, DLRET/DLRETX A/S, SICCD Z")

DAILY_STOCK_NEW = spec(
    "equity.daily_stock_new",
    "PERMNO:long! DlyCalDt:date! YYYYMMDD:long DlyPrc:double DlyRet:double DlyRetx:double DlyVol:long "
    "ShrOut:long DlyCap:double DisPERMCO:int",
    sort_key=("PERMNO", "DlyCalDt"), budget_rows=100)

FORWARD_PRICE = spec(
    "options.forward_price",
    "secid:long! date:date! expiration:date! AMSettlement:short ForwardPrice:double",
    sort_key=("secid", "date", "expiration"), budget_rows=100)

ZERO_CURVE = spec(
    "options.zero_curve",
    "date:date! days:int! rate:double!",
    sort_key=("date", "days"), budget_rows=100)

ADJUSTMENTS = spec(
    "estimates.adjustments",
    "TICKER:string! SPDATES:date! ADJ:double!",
    sort_key=("TICKER", "SPDATES"), budget_rows=100, budget_ratio=0.001)

SECURITY_PRICES = spec(
    "options.security_prices",
    "secid:long! date:date! open:double high:double low:double close:double volume:long return:double "
    "cfadj:double",
    sort_key=("secid", "date"), budget_rows=100,
    comment="`return` is a reserved word: quote it")

RESTATED_ACTUALS = spec(
    "estimates.restated_actuals",
    "TICKER:string! MEASURE:string! PDICITY:string! PENDS:date! VALUE:double ACTDATS:date! ACTTIMS:string! "
    "ANNDATS:date",
    sort_key=("TICKER", "MEASURE", "PDICITY", "PENDS", "ACTDATS"), budget_rows=100, budget_ratio=0.001)

EXCLUDED_ESTIMATES = spec(
    "estimates.excluded",
    "TICKER:string! ESTIMATOR:string! ANALYS:string FPI:string! MEASURE:string! FPEDATS:date! ACTDATS:date! "
    "EXCFLA EXCDATS:date EXCENDS:date",
    sort_key=("TICKER", "MEASURE", "FPI", "FPEDATS", "ACTDATS", "ESTIMATOR"), budget_rows=1000, budget_ratio=0.001,
    comment="exclusion window [EXCDATS, EXCENDS]; far-future or missing end = still excluded")

STOPPED_ESTIMATES = spec(
    "estimates.stopped",
    "TICKER:string! ESTIMATOR:string! PDICITY:string! MEASURE:string! FPEDATS:date! ASTPDATS:date! ASTPTIMS",
    sort_key=("TICKER", "MEASURE", "PDICITY", "FPEDATS", "ASTPDATS", "ESTIMATOR"), budget_rows=1000,
    budget_ratio=0.001)

PRICE_TARGETS = spec(
    "estimates.price_targets",
    "TICKER:string! ESTIMID:string! AMASKCD HORIZON:int VALUE:double ACTDATS:date! ANNDATS:date",
    sort_key=("TICKER", "ACTDATS", "ESTIMID"), budget_rows=1000, budget_ratio=0.001)

STOP_PRICE_TARGETS = spec(
    "estimates.stop_price_targets",
    "TICKER:string! ESTIMID:string! STPDATS:date!",
    sort_key=("TICKER", "STPDATS", "ESTIMID"), budget_rows=100, budget_ratio=0.001)

IDENTIFIER = spec(
    "estimates.identifier",
    "TICKER:string! SDATES:date! PDI DILFAC:double!",
    sort_key=("TICKER", "SDATES"), budget_rows=100, budget_ratio=0.001)

OPTION_PRICING = spec(
    "options.option_pricing",
    "optionid:long! date:date! secid:long! exdate:date! cp_flag:string! strike_price:long! best_bid:double "
    "best_offer:double volume:long open_interest:long impl_volatility:double delta:double gamma:double "
    "vega:double theta:double forward_price:double",
    sort_key=("secid", "date", "optionid"), natural_key=("optionid", "date"), budget_rows=100, budget_ratio=0.001,
    comment="strike_price is strike x 1000")

RATIOS = spec(
    "fundamentals.ratios",
    "gvkey:string! permno:long public_date:date! divyield",
    sort_key=("gvkey", "public_date"), comment="divyield is text with a percent sign")

SEGMENTS = spec(
    "fundamentals.segments",
    "gvkey:string! datadate:date! stype:string! sales:double",
    sort_key=("gvkey", "datadate", "stype"))

MARKET_RETURNS = spec(
    "equity.market_returns",
    "DlyCalDt:date! vwretd:double ewretd:double",
    sort_key=("DlyCalDt",), budget_rows=100)

DISTRIBUTIONS = spec(
    "equity.distributions",
    "PERMNO:long! DisExDt:date! DisDivAmt:double",
    sort_key=("PERMNO", "DisExDt"), budget_rows=100)

CATALOG = {s.name: s for s in (ESTIMATE_HISTORY, LINK, SECURITY_NAMES, CONSTITUENTS, DAILY_STOCK_OLD,
                               DAILY_STOCK_NEW, FORWARD_PRICE, ZERO_CURVE, ADJUSTMENTS, SECURITY_PRICES,
                               RESTATED_ACTUALS, EXCLUDED_ESTIMATES, STOPPED_ESTIMATES, PRICE_TARGETS,
                               STOP_PRICE_TARGETS, IDENTIFIER, OPTION_PRICING, RATIOS, SEGMENTS, MARKET_RETURNS,
                               DISTRIBUTIONS)}
