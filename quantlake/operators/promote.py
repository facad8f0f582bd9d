"""Staged incremental load: overlap check, anti-join promote, audits.

A chunk lands in staging; only rows whose natural key is not yet in main are
appended.  The anti join makes the promote idempotent: re-running a chunk, or
loading chunks that overlap, never doubles a row.

Scale notes: the anti/semi joins shuffle both sides on the key (main is the
build side, so it cannot be broadcast); AQE's skew-join handling splits a hot
key on the staging side.  Only the distinct keys of main are needed, and
Spark prunes main to the key columns at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.operators.quality import keep_one
from quantlake.session import path_exists, scratch_path

# fixed values: natural key of the estimate history (promote uses all ten, the QC
# duplicate/overlap checks the first eight)
PROMOTE_KEY = ("TICKER", "MEASURE", "FPI", "FPEDATS", "ESTIMATOR", "ANALYS",
               "ACTDATS", "ACTTIMS", "ANNDATS", "ANNTIMS")
QC_KEY = PROMOTE_KEY[:8]


def _keys(main: DataFrame, key: Sequence[str], staging: DataFrame | None = None,
          prune_on: str | None = None) -> DataFrame:
    """Key columns of main, optionally limited to the staged chunk's range of ``prune_on``.

    Main rows outside [min, max] of a key column in staging cannot match, so
    the range filter is exact; it reaches the Parquet scan (partition and
    row-group pruning on a table laid out by that column).  The two bounds are
    scalar subqueries: they stay in the column's own type and never pass through
    the session's time zone, and nothing runs while the query is built.
    """
    keys = main.select(*key)
    if prune_on and staging is not None:
        lo, hi = (staging.agg(f(prune_on)).scalar() for f in (F.min, F.max))
        keys = keys.where(F.col(prune_on).isNull() | F.col(prune_on).between(lo, hi))
    return keys


def _match(left: DataFrame, keys: DataFrame, key: Sequence[str], how: str, bucketed: bool = False) -> DataFrame:
    """Semi or anti join of ``left`` with ``keys`` in which NULL key parts equal each other.

    One null-safe join, so both sides are read once.  A ``bucketed`` main keeps its
    layout only in a plain equality join: rows with whole keys join on the columns then,
    and the few with a NULL part meet only main's rows with one.
    """
    def safe(rows: DataFrame, others: DataFrame) -> DataFrame:
        renamed = others.select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(key)])
        same = F.lit(True)
        for i, k in enumerate(key):
            same = same & F.col(k).eqNullSafe(F.col(f"_m{i}"))
        return rows.join(renamed, same, how).select(*left.columns)

    if not bucketed:
        return safe(left, keys)
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    plain = left.where(whole).join(keys, list(key), how).select(*left.columns)
    return plain.unionByName(safe(left.where(~whole), keys.where(~whole)))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table at ``path``, or no rows where the folder doesn't exist; any other failure is raised."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def overlap_count(staging: DataFrame, main: DataFrame, key: Sequence[str], prune_on: str | None = None) -> DataFrame:
    """Staging rows whose key already exists in main (``EXISTS``, no fan-out; NULL parts equal each other)."""
    return (_match(staging.select(*key), _keys(main, key, staging, prune_on), key, "left_semi")
                   .agg(F.count(F.lit(1)).alias("rows_already_in_main")))


def new_rows(staging: DataFrame, main: DataFrame, key: Sequence[str], dedupe_within: bool = False,
             order: Sequence[str] | None = None, prune_on: str | None = None, bucketed: bool = False) -> DataFrame:
    """Staging rows whose key is not in main (a NULL-safe ``LEFT ANTI JOIN``).

    ``dedupe_within=True`` also keeps one row per key inside the chunk (the
    reference does not; rows duplicated inside a chunk are appended twice).
    NULL key parts equal each other, so a row with one is not appended again
    when its chunk is promoted again.  ``prune_on`` names a key column (a
    date) to limit the main side to the chunk's range.  ``bucketed``: main is
    stored in buckets of the key.
    """
    out = _match(staging, _keys(main, key, staging, prune_on), key, "left_anti", bucketed)
    if dedupe_within:
        out = keep_one(out, list(key), list(order or out.columns))
    return out


def tagged(staging: DataFrame, main: DataFrame, key: Sequence[str], prune_on: str | None = None, flag: str = "_in_main") -> DataFrame:
    """Staging rows with ``flag``: whether their key is in main (NULL parts equal each other).

    One pass over staging and one over main's keys serve both D6 (rows with the
    flag) and the promote (rows without it).
    """
    keys = _keys(main, key, staging, prune_on).select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(key)], F.lit(True).alias("_hit")).distinct()
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_m{i}"))
    return staging.join(keys, same, "left").select(*staging.columns, F.col("_hit").isNotNull().alias(flag))


def pre_promote(main: DataFrame, staging: DataFrame) -> DataFrame:
    """D7 pre-promote row: main and staging counts, one aggregate over a tagged union."""
    t = main.select(F.lit("m").alias("_src")).unionByName(staging.select(F.lit("s").alias("_src")))
    return t.agg(F.count_if(F.col("_src") == "m").alias("main_rows_before"),
                 F.count_if(F.col("_src") == "s").alias("staging_rows")) \
        .select(F.lit("pre_promote").alias("check"), "main_rows_before", "staging_rows")


def post_promote(main: DataFrame, date_cols: Sequence[str] = ("ACTDATS", "ANNDATS")) -> DataFrame:
    """D7 post-promote row: count and date range of main, in one aggregate."""
    exprs = [F.count(F.lit(1)).alias("main_rows_after")]
    for c in date_cols:
        exprs += [F.min(c).alias(f"main_min_{c.lower()}"), F.max(c).alias(f"main_max_{c.lower()}")]
    return main.agg(*exprs).select(F.lit("post_promote").alias("check"), "*")


def promote_plan(staging: DataFrame, main: DataFrame, key: Sequence[str],
                 date_cols: Sequence[str], dedupe_within: bool = False) -> DataFrame:
    """The whole promote as one lazy audit row (no write): before, new, after.

    Main, staging and the new rows are tagged and unioned (date columns
    only), and one aggregate yields every figure — no join of one-row frames.
    """
    new = new_rows(staging, main, key, dedupe_within)
    cols = list(date_cols)
    t = (main.select(F.lit("m").alias("_src"), *cols)
         .unionByName(staging.select(F.lit("s").alias("_src"), *cols))
         .unionByName(new.select(F.lit("n").alias("_src"), *cols)))
    src = F.col("_src")
    after = src.isin("m", "n")
    exprs = [F.count_if(src == "m").alias("main_rows_before"), F.count_if(src == "s").alias("staging_rows"),
             F.count_if(src == "n").alias("rows_promoted"), F.count_if(after).alias("main_rows_after")]
    for c in cols:
        exprs += [F.min(F.when(after, F.col(c))).alias(f"main_min_{c.lower()}"),
                  F.max(F.when(after, F.col(c))).alias(f"main_max_{c.lower()}")]
    return t.agg(*exprs)


def promote(spark: SparkSession, staging: DataFrame, main_path: str, key: Sequence[str],
            date_cols: Sequence[str] = ("ACTDATS", "ANNDATS"), dedupe_within: bool = False,
            partition_by: Sequence[str] | None = None, prune_on: str | None = None) -> DataFrame:
    """Append the new rows of ``staging`` to the Parquet table at ``main_path``.

    Order of work: new rows are written to a fresh folder under the shared
    checkpoint directory first, then appended to main.  A crash at any point
    can be re-run: the anti join skips whatever already reached main.
    Returns the audit (pre and post rows) as a small DataFrame.
    """
    main = read_or_empty(spark, main_path, staging.schema)
    pre = pre_promote(main, staging).first()
    new = new_rows(staging, main, key, dedupe_within, prune_on=prune_on).select(*staging.columns)
    stage_path = scratch_path(spark, "promote")
    new.write.mode("overwrite").parquet(stage_path)
    landed = spark.read.parquet(stage_path)
    w = landed.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(main_path)
    after = spark.read.parquet(main_path)
    post = post_promote(after, date_cols).first()
    rows = [("pre_promote", "main_rows_before", float(pre["main_rows_before"])),
            ("pre_promote", "staging_rows", float(pre["staging_rows"])),
            ("post_promote", "rows_promoted", float(landed.count())),
            ("post_promote", "main_rows_after", float(post["main_rows_after"]))]
    return spark.createDataFrame(rows, "check string, metric string, value double")


def promote_to_table(spark: SparkSession, staging: DataFrame, table: str, key: Sequence[str],
                     buckets: int, path: str, dedupe_within: bool = False,
                     prune_on: str | None = None) -> DataFrame:
    """T2 on a catalog table bucketed by the natural key.

    The anti join reads main in its bucket layout (no exchange on main);
    only the staged chunk is shuffled into ``buckets`` partitions.  New rows
    are staged in the shared folder, then appended with the same bucket spec.
    Returns the audit rows like :func:`promote`.
    """
    from quantlake.sources.sinks import table_exists, write_bucketed

    if not table_exists(spark, table):
        write_bucketed(spark.createDataFrame([], staging.schema), table, key, buckets, path)
    main = spark.table(table)
    before = main.count()
    new = new_rows(staging, main, key, dedupe_within, prune_on=prune_on, bucketed=True).select(*staging.columns)
    stage_path = scratch_path(spark, "promote")
    new.write.mode("overwrite").parquet(stage_path)
    landed = spark.read.parquet(stage_path)
    write_bucketed(landed, table, key, buckets, path, mode="append")
    spark.catalog.refreshTable(table)
    rows = [("pre_promote", "main_rows_before", float(before)),
            ("pre_promote", "staging_rows", float(staging.count())),
            ("post_promote", "rows_promoted", float(landed.count())),
            ("post_promote", "main_rows_after", float(spark.table(table).count()))]
    return spark.createDataFrame(rows, "check string, metric string, value double")


def chunk_job(spark: SparkSession, spec, csv_path: str, staging_path: str, main_path: str,
              key: Sequence[str] | None = None, date_cols: Sequence[str] = (),
              null_rules=None, value_col: str | None = None, code_cols: Sequence[str] = (),
              thresholds=None, prune_on: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """C2 end to end: land a chunk, check it, promote it only if the gate passes.

    1. the CSV is parsed once into ``staging_path`` (overwritten: the truncate
       of the staging table), rejecting rows under the spec's error budget;
    2. D1–D5 run as one fused aggregate over staging, D6 as a semi join;
    3. the gate (D8) compares them with ``thresholds``;
    4. only if every check passes are the new rows promoted (T2), after
       which staging is truncated (S13); a failed gate leaves it for inspection.
    Returns ``(gate, audit)``; ``audit`` is None when the gate failed.
    """
    from quantlake.operators import quality as Q
    from quantlake.sources.ingest import load

    key = list(key or spec.natural_key)
    good_path = staging_path.rstrip("/") + "_table"
    load(spark, spec, csv_path, good_path, staging_path.rstrip("/") + "_parse", mode="overwrite")
    staging = spark.read.parquet(good_path)
    wide = Q.staging_qc(staging, list(date_cols), null_rules or {}, value_col or key[0], list(code_cols), key) \
        if value_col else Q.row_count_and_range(staging, list(date_cols), check=None)
    checks = Q.tidy(wide, "staging_qc")
    main = read_or_empty(spark, main_path, staging.schema)      # no rows before the first chunk: the overlap is 0
    checks = checks.unionByName(Q.tidy(overlap_count(staging, main, key, prune_on), "overlap_with_main"))
    gate_df = Q.gate(checks, thresholds or {("staging_qc", "rows"): (">", 0)})
    # a few metric rows: keep them as data, so the result outlives the staging files
    gate_df = spark.createDataFrame(gate_df.collect(), gate_df.schema)
    if gate_df.where(~F.col("passed")).limit(1).count() > 0:
        return gate_df, None
    audit = promote(spark, staging, main_path, key, date_cols=list(date_cols), prune_on=prune_on)
    # the audit is computed; clear staging (S13) only after main holds the rows
    audit = spark.createDataFrame(audit.collect(), audit.schema)
    from quantlake.sources.sinks import truncate
    truncate(spark, good_path, staging.schema)
    return gate_df, audit
