"""Table management and writers: ensure-table, clustered write, range export, reload.

Parquet on a shared file system stands in for the warehouse tables.  Every
writer goes through Spark's commit protocol, so a lost executor only re-runs
its tasks; nothing is staged on a machine-local disk.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.session import path_exists
from pyspark.sql.types import StructType

from quantlake.functions.scalars import date_range

# fixed values: export layout of the cold-storage dump
EXPORT_CODEC = "zstd"
EXPORT_ROW_GROUP_ROWS = 1_000_000


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Make sure a Parquet table exists at ``path``; never drops data.

    If the folder already holds a table it is read as is; otherwise an empty
    table with ``schema`` is written.  (The reference's loader dropped and
    recreated the table on any insert failure; this never does.)
    """
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        empty = spark.createDataFrame([], schema)
        w = empty.write.mode("ignore")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return spark.read.schema(schema).parquet(path)


def clone_schema(df: DataFrame) -> StructType:
    """``CREATE TABLE x AS y`` without data — reuse the schema."""
    return df.schema


def write_clustered(df: DataFrame, path: str, sort: Sequence[str], partition_by: Sequence[str] = (),
                    partitions: int | None = None, mode: str = "overwrite",
                    row_group_rows: int | None = None, codec: str = EXPORT_CODEC) -> str:
    """Write ordered by ``sort`` (range partitions, sorted inside each).

    Range partitioning samples the sort key, so partitions are balanced even
    when one key holds many rows; each file then covers a narrow key range
    and Parquet min/max statistics skip row groups on later range filters.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = list(partition_by) + list(sort)
    out = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    w = out.write.mode(mode).option("compression", codec)
    if row_group_rows:
        w = w.option("parquet.block.row.count.limit", str(row_group_rows))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def export_name(table: str, start: str, end: str, greeks_only: bool = False, label: str | None = None) -> str:
    """date-stamped dump name ``<table>[_<label>]_<YYYYMMDD>_<YYYYMMDD>`` (label ``greeks`` by default for a subset)."""
    s = dt.date.fromisoformat(start).strftime("%Y%m%d")
    e = dt.date.fromisoformat(end).strftime("%Y%m%d")
    label = label or ("greeks" if greeks_only else "")
    return f"{table}{'_' + label if label else ''}_{s}_{e}"


def range_frame(df: DataFrame, date_col: str, start: str, end: str,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Closed date range and optional column subset (pushed to the scan)."""
    out = df.where(date_range(date_col, start, end))
    return out.select(*columns) if columns else out


def export_range(df: DataFrame, date_col: str, start: str, end: str, out_dir: str, table: str,
                 columns: Sequence[str] | None = None, dry_run: bool = False,
                 sort: Sequence[str] | None = None, label: str | None = None) -> DataFrame:
    """Dump a date range to zstd Parquet with 1M-row groups.

    ``label`` names a column subset; a dump that is there already with other
    columns is not overwritten (``ValueError``).

    ``dry_run`` returns the row count only (no write).  Otherwise the rows are
    written under ``out_dir/<date-stamped name>`` and the written table is
    returned (read back), so callers can check what landed.
    """
    rng = range_frame(df, date_col, start, end, columns)
    if dry_run:
        return rng.agg(F.count(F.lit(1)).alias("rows"))
    path = os.path.join(out_dir, export_name(table, start, end, bool(columns), label))
    if path_exists(df.sparkSession, path) and (there := df.sparkSession.read.parquet(path).columns) != rng.columns:
        raise ValueError(f"{path} holds the columns {there}; give this subset a label of its own")
    if sort:
        rng = rng.repartitionByRange(*sort).sortWithinPartitions(*sort)
    (rng.write.mode("overwrite").option("compression", EXPORT_CODEC)
        .option("parquet.block.row.count.limit", str(EXPORT_ROW_GROUP_ROWS)).parquet(path))
    return reload(df.sparkSession, path)


def reload(spark: SparkSession, path: str) -> DataFrame:
    """Read a dump back (append it elsewhere with ``write.mode('append')``)."""
    return spark.read.parquet(path)


def extract_range(df: DataFrame, columns: Sequence[str], date_col: str, start: str, end: str) -> DataFrame:
    """T5: a few columns of a date range (the vendor-database extract, over files)."""
    return range_frame(df, date_col, start, end, columns)


def expand_ranges(spark: SparkSession, spec: Sequence[str | int | tuple[str, str]]) -> DataFrame:
    """A download list of years or (start, end) ranges → one row per chunk: start, end, name.

    A bare year expands to the whole year.  ``name`` is the chunk's file name without an
    ending (``1996-01 to 1996-12``; ``scalars.filename_range`` reads whole months back from it).  Chunks are
    rows of a DataFrame, and a loader iterates over chunks, never rows.
    """
    rows = []
    for item in spec:
        if isinstance(item, (int, str)) and str(item).isdigit():
            y = int(item)
            rows.append((f"{y:04d}-01-01", f"{y:04d}-12-31"))
        else:
            a, b = item
            rows.append((str(a), str(b)))
    df = spark.createDataFrame(rows, "start string, end string")
    df = df.select(F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))
    return df.withColumn("name", F.concat(F.date_format("start", "yyyy-MM"), F.lit(" to "), F.date_format("end", "yyyy-MM")))


def files_by_size(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The files of a folder, largest first, so big chunks start early.

    Only file metadata is read (the binary source skips the content column
    when it is not selected).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime").orderBy(F.col("length").desc(), "path")


def write_bucketed(df: DataFrame, table: str, key: Sequence[str], buckets: int, path: str,
                   mode: str = "overwrite") -> None:
    """Write ``df`` as a catalog table bucketed and sorted by ``key`` at ``path``.

    Later joins and anti joins on exactly ``key`` read the table with its
    bucket layout and shuffle only the other side — the big table never
    moves again.  ``path`` should be in shared storage.
    """
    (df.write.mode(mode).bucketBy(buckets, *key).sortBy(*key)
       .option("path", path).saveAsTable(table))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ensure_catalog_table(spark: SparkSession, spec, path: str, name: str | None = None,
                         column_comments: dict[str, str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` from a ``TableSpec``.

    Column names are back-quoted (``return`` is a reserved word), NOT NULL and
    comments come from the spec; an existing table is left as it is.
    Returns the table name (dots in the spec name become ``_``).
    """
    name = name or spec.name.replace(".", "_")
    comments = dict(column_comments or {})
    cols = []
    for c in spec.columns:
        ddl = f"`{c.name}` {c.spark_type.simpleString()}{'' if c.nullable else ' NOT NULL'}"
        text = comments.get(c.name, c.comment)
        if text:
            ddl += " COMMENT '" + text.replace("'", "\\'") + "'"
        cols.append(ddl)
    table_comment = (" COMMENT '" + spec.comment.replace("'", "\\'") + "'") if spec.comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({', '.join(cols)}) USING parquet "
              f"LOCATION '{path}'{table_comment}")
    return name


def truncate(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty a staging table in place (overwrite with no rows, schema kept)."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def date_predicates(col: str, start: str, end: str, step_days: int = 31) -> list[str]:
    """Non-overlapping ``col`` ranges covering [start, end]; one JDBC read task each."""
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    out, lo = [], a
    while lo <= b:
        hi = min(lo + dt.timedelta(days=step_days - 1), b)
        out.append(f"{col} >= DATE '{lo.isoformat()}' AND {col} <= DATE '{hi.isoformat()}'")
        lo = hi + dt.timedelta(days=1)
    return out


def extract_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str], date_col: str,
                 start: str, end: str, properties: dict | None = None, step_days: int = 31) -> DataFrame:
    """S19/T5 against a database: a few columns of a date range, read in parallel.

    Each date range becomes one partition's ``WHERE`` clause, so the database
    filters and the read is spread over tasks.  (No database runs in this
    repository's tests; only the predicate split is tested.)
    """
    sel = "(SELECT " + ", ".join(columns) + f" FROM {table}) AS src"
    return spark.read.jdbc(url, sel, predicates=date_predicates(date_col, start, end, step_days),
                           properties=properties or {})
