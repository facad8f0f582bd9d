"""Typed CSV ingest with by-name column mapping, row checks and an error budget.

Spark's CSV reader with a user schema maps columns by *position*; vendor
extracts are matched by *name*.  So the file is read as strings with the
file's own header order (plus ``_corrupt_record`` to catch rows of the wrong
width), and the typed projection selects the spec's columns by name.

A row is rejected when its width is wrong or any non-empty cell does not
parse as its declared type.  Empty cells become NULL (nullable columns) or the
type default (NOT NULL columns).  The load fails only when the rejects exceed
both the row budget and the ratio budget.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantlake.functions import scalars as S
from quantlake.sources.specs import TableSpec

CORRUPT = "_corrupt_record"
# fixed values: delimiters the sniffer considers, in preference order
DELIMITERS = (",", "\t", ";", "|")
_DEFAULTS = {"string": "''", "int": "0", "long": "0", "short": "0", "double": "0.0",
             "boolean": "false", "date": None}
_INT_RANGES = {"int": (-2**31, 2**31 - 1), "short": (-2**15, 2**15 - 1)}


class BudgetExceeded(RuntimeError):
    pass


class HeaderMismatch(RuntimeError):
    pass


@dataclass(frozen=True)
class LoadOptions:
    sep: str | None = None          # None → sniff from the header line
    header: bool = True
    encoding: str = "UTF-8"
    quote: str = '"'
    escape: str = '"'
    multi_line: bool = False        # quoted line breaks; such files cannot be split, so only where a vendor writes them
    allow_missing: tuple[str, ...] = ()      # spec columns that a file may lack
    allow_extra: bool | tuple[str, ...] = False  # file columns that may be dropped (True: any)


def header_line(spark: SparkSession, path: str) -> str:
    """First line of the first file (one line, not the data)."""
    row = spark.read.text(path).limit(1).first()
    return row[0] if row else ""


def sniff_delimiter(line: str, candidates: Sequence[str] = DELIMITERS) -> str:
    """The candidate that occurs most often in the header line (ties: first)."""
    counts = [(line.count(c), -i, c) for i, c in enumerate(candidates)]
    best = max(counts)
    return best[2] if best[0] > 0 else ","


def header_columns(line: str, sep: str) -> list[str]:
    return [c.strip().strip('"') for c in line.split(sep)]


def header_check(spark: SparkSession, spec: TableSpec, path: str, sep: str | None = None) -> DataFrame:
    """Compare a file's header with the spec: ``ok``, ``missing``, ``extra``, ``case``.

    ``case`` marks a header column that matches a spec column only when
    case is ignored (a renamed column the by-name mapping would miss).
    """
    line = header_line(spark, path)
    cols = header_columns(line, sep or sniff_delimiter(line))
    want = spec.names
    lower_want = {w.lower(): w for w in want}
    rows = []
    for i, w in enumerate(want):
        rows.append((w, "ok" if w in cols else "missing", i))
    for c in cols:
        if c not in want:
            rows.append((c, "case" if c.lower() in lower_want else "extra", None))
    return spark.createDataFrame(rows, "column string, status string, position int")


def _read(spark: SparkSession, paths: str | list[str], cols: Sequence[str], sep: str, opts: LoadOptions) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols]
                          + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(schema)
            .option("header", str(opts.header).lower()).option("sep", sep)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            # every file's own header is compared with the given one; another order or name fails the read
            .option("enforceSchema", str(not opts.header).lower()).option("multiLine", str(opts.multi_line).lower())
            .option("encoding", opts.encoding)
            .option("quote", opts.quote).option("escape", opts.escape)
            .csv(paths))


def read_raw(spark: SparkSession, path: str, opts: LoadOptions = LoadOptions()) -> tuple[DataFrame, list[str], str]:
    """All-string read in the file's header order, with ``_corrupt_record`` for width errors; one header for all files."""
    line = header_line(spark, path)
    sep = opts.sep or sniff_delimiter(line)
    cols = header_columns(line, sep)
    return _read(spark, path, cols, sep, opts), cols, sep


def first_line(spark: SparkSession, file: str, encoding: str = "UTF-8") -> str:
    """First line of one file, through the file system's own client (a compressed file through Spark's reader)."""
    if file.lower().endswith((".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate")):
        return header_line(spark, file)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine() or ""
    finally:
        stream.close()


def header_groups(spark: SparkSession, files: Sequence[str], opts: LoadOptions = LoadOptions()) -> list[tuple[list[str], str, list[str]]]:
    """(columns, delimiter, files) for each different header among ``files``; a line a file is read, no data.

    Files without any line are left out.
    """
    groups: dict[tuple, list[str]] = {}
    for f in sorted(files):
        line = first_line(spark, f, opts.encoding)
        if line:
            sep = opts.sep or sniff_delimiter(line)
            groups.setdefault((tuple(header_columns(line, sep)), sep), []).append(f)
    return [(list(cols), sep, fs) for (cols, sep), fs in groups.items()]


def typed_files(spark: SparkSession, spec: TableSpec, files: Sequence[str], opts: LoadOptions = LoadOptions()) -> DataFrame:
    """:func:`typed` rows of all files plus ``_file``: one read for each different header, united by name.

    Every header is checked (:func:`check_header`) before anything is read.
    """
    groups = header_groups(spark, files, opts)
    for cols, _, _ in groups:
        check_header(spec, cols, opts.allow_missing, opts.allow_extra)
    parts = [typed(_read(spark, fs, cols, sep, opts).withColumn("_file", F.col("_metadata.file_path")), spec, cols, ["_file"]) for cols, sep, fs in groups]
    if not parts:
        none = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*spec.names, CORRUPT, "_file")]))
        parts = [typed(none, spec, spec.names, ["_file"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# fixed values: texts that stand for a missing number
_NOT_A_NUMBER = r"(?i)^[+-]?(nan|inf|infinity)$"


def _parse(raw: Column, type_: str, patterns: Sequence[str] | None) -> Column:
    if type_ == "string":
        return raw
    if type_ in ("int", "short", "long"):
        v = S.to_long_or_null(raw)
        if type_ in _INT_RANGES:
            lo, hi = _INT_RANGES[type_]
            v = F.when(v.between(lo, hi), v)
        return v.cast({"int": "int", "short": "short", "long": "long"}[type_])
    if type_ == "double":
        return F.when(~raw.rlike(_NOT_A_NUMBER), S.to_double_or_null(raw))
    if type_ == "date":
        return S.parse_date(raw, patterns or S.DATE_PATTERNS)
    if type_ == "boolean":
        return F.when(F.lower(raw).isin("1", "true", "t", "y"), F.lit(True)) \
            .when(F.lower(raw).isin("0", "false", "f", "n"), F.lit(False))
    raise ValueError(type_)


def typed(raw_df: DataFrame, spec: TableSpec, file_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection by name plus ``_bad`` (first failing column or ``width``) and the columns of ``keep`` as they are.

    Columns the file lacks are NULL (or the default when NOT NULL); the
    header check reports them.
    """
    present = set(file_cols)
    values, bad = [], []
    for c in spec.columns:
        raw = F.col(f"`{c.name}`") if c.name in present else F.lit(None).cast("string")
        blank = raw.isNull() | (F.length(F.trim(raw)) == 0) | (F.trim(raw) == "\\N")
        if c.type == "double":
            blank = blank | F.trim(raw).rlike(_NOT_A_NUMBER)
        parsed = _parse(F.trim(raw) if c.type != "string" else raw, c.type, spec.date_patterns)
        if c.nullable:
            default = F.lit(None).cast(c.spark_type)
        elif c.type == "date":
            default = F.lit(spec.missing_date_default).cast("date")
        else:
            default = F.expr(_DEFAULTS[c.type]).cast(c.spark_type)
        values.append(F.when(blank, default).otherwise(parsed).alias(c.name))
        bad.append((c.name, ~blank & parsed.isNull()))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("width"))
    for name, cond in bad:
        reason = reason.when(cond, F.lit(name))
    return raw_df.select(*values, reason.alias("_bad"),
                         F.when(reason.isNotNull(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in file_cols]))).alias("_raw"),
                         F.col(CORRUPT), *keep)


def check_header(spec: TableSpec, file_cols: Sequence[str], allow_missing: Sequence[str] = (),
                 allow_extra: bool | Sequence[str] = False) -> None:
    """Raise ``HeaderMismatch`` on spec columns the file lacks (also by case) and on unnamed extra columns."""
    missing = [c for c in spec.names if c not in file_cols and c not in allow_missing]
    extra = [c for c in file_cols if c not in spec.names]
    unnamed = [] if allow_extra is True else [c for c in extra if c not in (allow_extra or ())]
    if missing or unnamed:
        raise HeaderMismatch(f"{spec.name}: missing {missing}, not in the spec {unnamed}")


def ingest(spark: SparkSession, spec: TableSpec, path: str,
           opts: LoadOptions = LoadOptions()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """T1 (lazy): ``(good, rejects, report)`` for a CSV extract.

    ``rejects`` keeps the raw cells (or the raw line for width errors) and the
    reason; ``report`` is one row with the counts and the budget verdict.  For
    a load that writes, use :func:`load`, which parses the file once.  Files of a
    folder may have different headers; each must name the spec's columns (``HeaderMismatch``).
    """
    return _split(typed_files(spark, spec, input_files(spark, path), opts), spec)


def input_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a read of ``path`` takes (a listing)."""
    return sorted(plain_path(spark, f) for f in spark.read.text(path).inputFiles())


def plain_path(spark: SparkSession, url: str) -> str:
    """A file's path as readers take it, from the escaped form in which Spark reports it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(url)).toString()


def _split(t: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    good = t.where(F.col("_bad").isNull()).select(*spec.names)
    rejects = t.where(F.col("_bad").isNotNull()).select(
        F.col("_bad").alias("reason"), F.coalesce(F.col(CORRUPT), F.col("_raw")).alias("raw"))
    report = budget_report(t, spec)
    return good, rejects, report


def budget_report(t: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows read, good, rejected and whether the budget holds (one aggregate)."""
    n = F.count(F.lit(1))
    bad = F.count_if(F.col("_bad").isNotNull())
    out = t.agg(n.alias("rows_read"), bad.alias("rows_rejected"))
    ratio = F.try_divide(F.col("rows_rejected").cast("double"), F.col("rows_read").cast("double"))
    over = (F.col("rows_rejected") > F.lit(spec.budget_rows)) & (F.coalesce(ratio, F.lit(0.0)) > F.lit(spec.budget_ratio))
    return out.select("rows_read", (F.col("rows_read") - F.col("rows_rejected")).alias("rows_good"),
                      "rows_rejected", F.round(ratio, 6).alias("reject_ratio"),
                      F.lit(spec.budget_rows).alias("budget_rows"), F.lit(spec.budget_ratio).alias("budget_ratio"),
                      (~over).alias("within_budget"))


def load(spark: SparkSession, spec: TableSpec, path: str, table_path: str, stage_path: str,
         opts: LoadOptions = LoadOptions(), mode: str = "append") -> DataFrame:
    """Parse once to a staged table, check the budget, then write.

    0. the header must have the spec's columns, in any order, and no others
       (``HeaderMismatch``; see ``LoadOptions.allow_missing`` and ``allow_extra``);
    1. the typed rows (with their reject reason) are written to ``stage_path``
       in the shared folder — the only pass over the CSV;
    2. the budget report is an aggregate over the staged ``_bad`` column;
    3. within budget, good rows are written to ``table_path`` (append, or
       overwrite for a full refresh); otherwise ``BudgetExceeded`` is raised
       and the table is untouched.  The table is never dropped on failure.
    Returns the report row (rows written = ``rows_good``).
    """
    typed_files(spark, spec, input_files(spark, path), opts).write.mode("overwrite").parquet(stage_path)
    staged = spark.read.parquet(stage_path)
    good, rejects, report = _split(staged, spec)
    r = report.first()
    if not r["within_budget"]:
        raise BudgetExceeded(f"{spec.name}: {r['rows_rejected']} bad rows of {r['rows_read']} "
                             f"(budget {spec.budget_rows} rows / {spec.budget_ratio})")
    good.write.mode(mode).parquet(table_path)
    return report


def load_chunks(spark: SparkSession, spec: TableSpec, folder: str, table_path: str,
                pattern: str = "*.csv", opts: LoadOptions = LoadOptions(), on_error: str = "raise") -> DataFrame:
    """Load every extract in ``folder`` as its own chunk, largest first.

    Each file is one :func:`load` (one parse, its own budget verdict); a file
    over budget raises, or with ``on_error='skip'`` is left out with
    ``status = 'over_budget'``.  The loop runs over files — the list is file
    metadata — never over rows.  Returns one report row per file.
    """
    from quantlake.session import scratch_path
    from quantlake.sources.sinks import files_by_size

    paths = [r["path"] for r in files_by_size(spark, folder, pattern).select("path").collect()]
    rows = []
    for p in paths:
        try:
            r = load(spark, spec, p, table_path, scratch_path(spark, "stage"), opts, mode="append").first()
            rows.append((p, "loaded", r["rows_read"], r["rows_good"], r["rows_rejected"]))
        except BudgetExceeded:
            if on_error == "raise":
                raise
            r = budget_report(typed_files(spark, spec, input_files(spark, p), opts), spec).first()
            rows.append((p, "over_budget", r["rows_read"], 0, r["rows_rejected"]))
    return spark.createDataFrame(rows, "file string, status string, rows_read long, rows_written long, "
                                       "rows_rejected long")
