"""Research panels: unified daily stock, returns, index returns, roll-ups, option chains.

Every running quantity (previous price, cumulative return) is an
:func:`ordered_scan`, split by month so a long-lived security is not one
task.  Pairings are equi joins on de-duplicated keys (1:1), never all pairs
within a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.functions.scalars import strike as strike_scale
from quantlake.operators.quality import keep_one
from quantlake.operators.joins import broadcast_if_small
from quantlake.operators.scan import ordered_scan, ordered_scans

# fixed values: old-format → new-format daily stock column names
OLD_TO_NEW = {"date": "DlyCalDt", "PRC": "DlyPrc", "RET": "DlyRet", "RETX": "DlyRetx", "VOL": "DlyVol",
              "SHROUT": "ShrOut", "BID": "DlyBid", "ASK": "DlyAsk", "BIDLO": "DlyLow", "ASKHI": "DlyHigh",
              "OPENPRC": "DlyOpen"}


def union_formats(old: DataFrame, new: DataFrame, column_map: Mapping[str, str], key: Sequence[str],
                  prefer: str = "new", latest: Sequence[str] | None = None) -> DataFrame:
    """Old-format rows renamed to the new names, unioned by name.

    ``latest`` (order columns of the common names, greatest first) keeps one row a key
    inside each source before they meet, for updates that repeat a key (U4).

    Where both formats have a key, the preferred side wins (an anti join
    drops the other side's rows).  A ``source`` column tells them apart;
    columns one side lacks are NULL.  Cumulative and daily factor columns
    are left as separate columns.
    """
    o = old.withColumnsRenamed(dict(column_map)).withColumn("source", F.lit("old"))
    n = new.withColumn("source", F.lit("new"))
    if latest is not None:
        o, n = (keep_one(x, list(key), [F.col(c).desc_nulls_last() for c in latest]) for x in (o, n))
    if prefer == "new":
        o = o.join(n.select(*key).distinct(), list(key), "left_anti")
    else:
        n = n.join(o.select(*key).distinct(), list(key), "left_anti")
    return n.unionByName(o, allowMissingColumns=True)


def lagged(df: DataFrame, key: Sequence[str], time: str, col: str, tie_break: Sequence[str] = (),
           stored_ret: str | None = None, tol: float = 1e-6, factor: str | None = None) -> DataFrame:
    """Previous value per key and the implied return ``col / prev − 1``.

    With ``factor`` (a cumulative price-adjustment factor column) the return
    uses adjusted prices ``col / factor``, so a split day does not show up as
    a price jump.  With ``stored_ret`` given, ``ret_matches`` compares the
    implied return with the stored one (within ``tol``).
    """
    order = [time, *tie_break]
    if factor is None:
        # the carried value is a struct, so a NULL of the row before stays a NULL (as lag gives it)
        out = ordered_scan(df, key, order, F.struct(F.col(col).alias("v")), "last", "_prev", inclusive=False)
        out = out.withColumn(f"prev_{col}", F.col("_prev.v")).drop("_prev").withColumn(f"ret_{col}", F.try_divide(F.col(col), F.col(f"prev_{col}")) - F.lit(1.0))
    else:
        px = F.try_divide(F.col(col), F.col(factor))
        out = ordered_scan(df.withColumn("_px", px), key, order, F.struct(F.col("_px").alias("px"), F.col(col).alias("v")),
                           "last", "_prev", inclusive=False)
        out = out.withColumn(f"prev_{col}", F.col("_prev.v")) \
            .withColumn(f"ret_{col}", F.try_divide(F.col("_px"), F.col("_prev.px")) - F.lit(1.0)).drop("_px", "_prev")
    if stored_ret:
        out = out.withColumn("ret_matches", F.abs(F.col(f"ret_{col}") - F.col(stored_ret)) <= F.lit(tol))
    return out


def cumulative_return(df: DataFrame, key: Sequence[str], time: str, ret: str,
                      tie_break: Sequence[str] = ()) -> DataFrame:
    """Running compounded return ``exp(Σ log1p(r)) − 1``; NULL returns skipped and counted.

    A return of −100 % (or below) wipes the position out: from that row on the
    cumulative return is −1 (``log1p`` alone would turn it into a NULL and
    silently skip it).
    """
    order = [time, *tie_break]
    r = F.col(ret)
    out = ordered_scans(df, key, order, [(F.when(r > -1, F.log1p(r)), "sum", "_lsum"),
                                         (r.isNull().cast("int"), "sum", "n_missing"),
                                         ((r <= -1).cast("int"), "sum", "_wiped")])
    cum = F.when(F.coalesce(F.col("_wiped"), F.lit(0)) > 0, F.lit(-1.0)).otherwise(F.exp(F.col("_lsum")) - F.lit(1.0))
    return out.withColumn("cum_ret", cum).drop("_lsum", "_wiped")


def index_returns(panel: DataFrame, date: str, ret: str, weight: str, digits: int = 6,
                  lag_by: Sequence[str] | None = None) -> DataFrame:
    """Value-weighted and equal-weighted mean return per date.

    With ``lag_by`` (the security key) the weight is the security's previous
    observation of ``weight`` (lagged market cap), found with the bucketed
    scan, so a day's return is weighted by the cap known before that day.
    """
    if lag_by:
        panel = ordered_scan(panel, list(lag_by), [date], F.struct(F.col(weight).alias("v")), "last", "_before", inclusive=False) \
            .withColumn("_w_lag", F.col("_before.v"))
        weight = "_w_lag"
    w, r = F.col(weight), F.col(ret)
    return panel.groupBy(date).agg(
        F.round(F.try_divide(F.sum(w * r), F.sum(F.when(r.isNotNull(), w))), digits).alias("vwret"),
        F.round(F.avg(r), digits).alias("ewret"),
        F.count(r).alias("n"))


# fixed value: the classes of a computed return against a stored one
_SAME, _CLOSE, _OFF, _ONLY_OURS, _ONLY_STORED = "same", "close", "off", "not stored", "not computed"


def index_panel(prices: DataFrame, members: DataFrame, key: Sequence[str], date: str, ret: str, weight: str,
                member_from: str, member_to: str, lag_by: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Value- and equal-weighted mean return per date over the constituents of that date.

    A security counts on the days inside one of its membership intervals (:func:`interval_join`;
    an open end by the link rules).  Lagged weights (``lag_by``) are taken before the
    membership, so the first day of a member is weighted by its cap of the day before.
    """
    from quantlake.operators.intervals import interval_join

    if lag_by:
        prices = ordered_scan(prices, list(lag_by), [date], F.struct(F.col(weight).alias("v")), "last", "_before", inclusive=False) \
            .withColumn("_w_lag", F.col("_before.v")).drop("_before")
        weight = "_w_lag"
    inside = interval_join(prices, members, list(key), date, member_from, member_to, how="left_semi")
    return index_returns(inside, date, ret, weight, digits)


def compare_returns(computed: DataFrame, stored: DataFrame, date: str, col: str, stored_col: str,
                    same: float = 1e-6, close: float = 1e-4) -> DataFrame:
    """Computed beside stored returns of every date that either has, with the class of their difference."""
    c, s = computed.select(date, F.col(col).alias("computed")), stored.select(date, F.col(stored_col).alias("stored"))
    diff = F.abs(F.col("computed") - F.col("stored"))
    return c.join(s, date, "full").withColumn("class", F.when(F.col("stored").isNull(), F.lit(_ONLY_OURS)).when(F.col("computed").isNull(), F.lit(_ONLY_STORED))
                                              .when(diff <= same, F.lit(_SAME)).when(diff <= close, F.lit(_CLOSE)).otherwise(F.lit(_OFF)))


def distribution_rollup(d: DataFrame, key: Sequence[str], date: str, amount: str) -> DataFrame:
    """Distributions per security and year (sum as exact decimal, count, last ex-date)."""
    return d.groupBy(*key, F.year(date).cast("int").alias("year")).agg(
        F.sum(F.col(amount).cast("decimal(18,4)")).cast("double").alias("total_amount"),
        F.count(F.lit(1)).alias("n_distributions"),
        F.max(F.col(date).cast("date")).alias("last_ex_date"))


def distribution_prices(dist: DataFrame, prices: DataFrame, key: Sequence[str], exdate: str, date: str,
                        cols: Sequence[str]) -> DataFrame:
    """Each distribution with the security's price row on its ex-date (left equi join)."""
    p = prices.select(*key, F.col(date).alias(exdate), *cols)
    return dist.join(p, list(key) + [exdate], "left")


def segment_totals(seg: DataFrame, firm: DataFrame, key: Sequence[str], seg_value: str, firm_value: str,
                   digits: int = 2) -> DataFrame:
    """Sum of segment values per firm-period vs the firm's own total."""
    s = seg.groupBy(*key).agg(F.sum(F.col(seg_value).cast("decimal(18,2)")).alias("_seg"),
                              F.count(F.lit(1)).alias("n_segments"))
    j = s.join(firm.select(*key, F.col(firm_value).cast("decimal(18,2)").alias("_firm")), list(key), "left")
    return j.select(*key, "n_segments", F.col("_seg").cast("double").alias("segment_total"),
                    F.col("_firm").cast("double").alias("firm_total"),
                    F.round((F.col("_seg") - F.col("_firm")).cast("double"), digits).alias("diff"))


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], max_dim_bytes: int = 256 << 20) -> DataFrame:
    """Fact ⨝ attribute table on same-named keys (left join).

    The attribute table is broadcast only when its estimated size is
    at most ``max_dim_bytes``; otherwise it is a shuffle join on the key.
    """
    return fact.join(broadcast_if_small(dim, max_dim_bytes), list(on), "left")


def chain(df: DataFrame, links: Sequence[tuple[DataFrame, str, str, Sequence[str]]],
          max_dim_bytes: int = 256 << 20) -> DataFrame:
    """Follow identifiers through a chain of lookups; ``matched_step`` = last step reached.

    ``links`` = [(table, from_col, to_col, keep_cols)] applied in order; each
    step is a left equi join (broadcast when proven small), so an unmatched
    id stops the chain without dropping the row.
    """
    out = df.withColumn("matched_step", F.lit(0))
    for i, (tbl, frm, to, keep) in enumerate(links, start=1):
        t = broadcast_if_small(tbl.select(F.col(to).alias(f"_to{i}"), *keep), max_dim_bytes)
        out = out.join(t, out[frm] == t[f"_to{i}"], "left")
        out = out.withColumn("matched_step", F.when(F.col(f"_to{i}").isNotNull() & (F.col("matched_step") == i - 1),
                                                    F.lit(i)).otherwise(F.col("matched_step"))).drop(f"_to{i}")
    return out


def option_features(chain_df: DataFrame, bid: str = "best_bid", offer: str = "best_offer",
                    strike_col: str = "strike_price", underlying: str = "underlying",
                    date: str = "date", exdate: str = "exdate") -> DataFrame:
    """Mid, spread, strike in price units, moneyness, days to expiry."""
    k = strike_scale(strike_col)
    return chain_df.withColumns({
        "mid": (F.col(bid) + F.col(offer)) / 2.0,
        "spread": F.col(offer) - F.col(bid),
        "strike": k,
        "moneyness": F.try_divide(k, F.col(underlying)),
        "dte": F.datediff(F.col(exdate), F.col(date)),
    })


def call_put_pairs(chain_df: DataFrame, key: Sequence[str] = ("secid", "date", "exdate", "strike_price"),
                   flag: str = "cp_flag", cols: Sequence[str] = ("mid",), order: Sequence[str] | None = None) -> DataFrame:
    """Put and call at the same (secid, date, expiry, strike), side by side.

    Each side is first reduced to one row per key (``keep_one``), so the
    pairing join is one-to-one — no product of duplicates within a key.
    """
    key = list(key)
    order = list(order or [c for c in chain_df.columns if c not in key])
    calls = keep_one(chain_df.where(F.col(flag) == "C"), key, order)
    puts = keep_one(chain_df.where(F.col(flag) == "P"), key, order)
    c = calls.select(*key, *[F.col(x).alias(f"call_{x}") for x in cols])
    p = puts.select(*key, *[F.col(x).alias(f"put_{x}") for x in cols])
    return c.join(p, key, "inner")


def fundamentals_panel(prices: DataFrame, fundamentals: DataFrame, link: DataFrame, known_at: str,
                       price_id: str = "PERMNO", date: str = "date", link_id: str = "LPERMNO",
                       firm: str = "gvkey", link_start: str = "LINKDT", link_end: str = "LINKENDDT",
                       cols: Sequence[str] | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Each price row with the firm's newest fundamentals known at the price date.

    1. the security-to-firm link is an interval join on the security id and
       the price date (open ends per the link rules);
    2. fundamentals are attached with a backward as-of join on the firm id,
       keyed by ``known_at`` (the report date), so nothing is used before it
       was published.  Rows without a link or without an earlier report keep
       NULLs.
    """
    from quantlake.operators.asof import asof_join
    from quantlake.operators.intervals import interval_join

    cols = list(cols or [c for c in fundamentals.columns if c not in (firm, known_at)])
    linked = interval_join(prices, link, {price_id: link_id}, date, link_start, link_end, dim_cols=[firm])
    f = fundamentals.select(firm, known_at, *[c for c in cols if c not in (firm, known_at)])
    return asof_join(linked, f, [firm], date, known_at, cols, tie_break=tie_break)
