"""Restartable load of a folder of extracts: a manifest says which files the table holds.

Rows of a file go into a folder of their own under the table (``chunk=<id>``, the id a
hash of path, size and checksum).  After the rows of a run's files are written, one
append to the manifest commits them.  A run that is killed anywhere can be started
again: files in the manifest are skipped, the others are written to the same folders
over what the killed run left there, and at the end folders that no current file
of the manifest owns are removed.  A file that comes again with other content replaces
its former rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.functions.scalars import filename_range
from quantlake.session import materialize, path_exists
from quantlake.sources import ingest as I
from quantlake.sources.specs import TableSpec

MANIFEST = "file string, bytes long, checksum long, chunk string, rows_read long, rows_written long, rows_rejected long, load_id long"


def fingerprints(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, bytes, checksum, chunk) of each file; the checksum is a sum over its lines' hashes, one pass over the text."""
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), "value")
    found = lines.groupBy("file").agg(F.max("bytes").alias("bytes"), F.sum(F.pmod(F.xxhash64("value"), F.lit(1 << 31))).alias("checksum"))
    chunk = F.substring(F.sha2(F.concat_ws("|", "file", F.col("bytes").cast("string"), F.col("checksum").cast("string")), 256), 1, 20)
    return found.withColumn("chunk", chunk)


def history(spark: SparkSession, manifest_path: str) -> DataFrame:
    """All entries of the manifest, none before the first load."""
    return spark.read.schema(MANIFEST).parquet(manifest_path) if path_exists(spark, manifest_path) else spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The newest entry of each file."""
    rest = [c.split()[0] for c in MANIFEST.split(", ")][1:]
    return history(spark, manifest_path).groupBy("file").agg(F.max_by(F.struct(*rest), "load_id").alias("e")).select("file", "e.*")


def loaded(spark: SparkSession, spec: TableSpec, table_path: str, manifest_path: str) -> DataFrame:
    """The committed rows: those of chunks that the manifest names, also while a load is under way."""
    rows = spark.read.parquet(table_path)
    return rows.join(F.broadcast(current(spark, manifest_path).select("chunk")), "chunk", "left_semi").select(*spec.names)


def load_once(spark: SparkSession, spec: TableSpec, path: str, table_path: str, manifest_path: str,
              opts: I.LoadOptions = I.LoadOptions(), on_error: str = "raise") -> DataFrame:
    """Load every file under ``path`` that the table does not hold yet, each once.

    All new files are parsed in one job for each different header, staged, and judged file by file
    against the spec's budget.  A file over budget raises ``BudgetExceeded`` before anything is written, or
    with ``on_error='skip'`` is left out (and tried again by the next run).  Returns one row a
    file: file, status (``loaded``, ``present`` or ``over_budget``), rows_read, rows_written, rows_rejected.
    What comes to the driver is a row for each file, never data.
    """
    files = I.input_files(spark, path)
    report = "file string, status string, rows_read long, rows_written long, rows_rejected long"
    if not files:
        return spark.createDataFrame([], report)
    prints = materialize(fingerprints(spark, files), "fingerprints")
    held = materialize(prints.join(current(spark, manifest_path).drop("bytes", "checksum"), ["file", "chunk"]), "held")
    new = prints.join(held.select("chunk"), "chunk", "left_anti")
    todo = [I.plain_path(spark, r["file"]) for r in new.select("file").collect()]
    present = held.select("file", F.lit("present").alias("status"), "rows_read", "rows_written", "rows_rejected")
    if not todo:
        _sweep(spark, table_path, manifest_path)
        return present
    staged = materialize(I.typed_files(spark, spec, todo, opts), "staged-files")
    bad = F.col("_bad").isNotNull()
    counts = staged.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(bad).alias("rows_rejected"))
    counts = new.join(counts, "file", "left").na.fill(0, ["rows_read", "rows_rejected"])
    over = (F.col("rows_rejected") > spec.budget_rows) & (F.try_divide(F.col("rows_rejected").cast("double"), F.col("rows_read").cast("double")) > spec.budget_ratio)
    verdict = materialize(counts.withColumn("over", F.coalesce(over, F.lit(False))), "file-verdicts")
    worst = verdict.where("over").orderBy(F.col("rows_rejected").desc(), "file").first()
    if worst is not None and on_error == "raise":
        raise I.BudgetExceeded(f"{spec.name}: {worst['rows_rejected']} bad rows of {worst['rows_read']} in {worst['file']}")
    accepted = verdict.where(~F.col("over"))
    rows = staged.where(~bad).join(F.broadcast(accepted.select(F.col("file").alias("_file"), "chunk")), "_file").select(*spec.names, "chunk")
    # only the folders of these chunks are replaced
    rows.write.partitionBy("chunk").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(table_path)
    commit(spark, accepted, manifest_path)
    _sweep(spark, table_path, manifest_path)
    done = verdict.select("file", F.when(F.col("over"), "over_budget").otherwise("loaded").alias("status"), "rows_read",
                          F.when(F.col("over"), F.lit(0)).otherwise(F.col("rows_read") - F.col("rows_rejected")).cast("long").alias("rows_written"), "rows_rejected")
    return done.unionByName(present)


def commit(spark: SparkSession, accepted: DataFrame, manifest_path: str) -> None:
    """Append the accepted files to the manifest, under a number greater than all before."""
    last = history(spark, manifest_path).agg(F.coalesce(F.max("load_id"), F.lit(0).cast("long"))).scalar()
    entries = accepted.select("file", "bytes", "checksum", "chunk", "rows_read", (F.col("rows_read") - F.col("rows_rejected")).alias("rows_written"),
                              "rows_rejected", (last + 1).alias("load_id"))
    materialize(entries, "manifest").coalesce(1).write.mode("append").parquet(manifest_path)


def _sweep(spark: SparkSession, table_path: str, manifest_path: str) -> None:
    """Remove chunk folders that no current file owns: superseded content, and what a killed run left of files since gone."""
    if not path_exists(spark, table_path):
        return
    owned = {r["chunk"] for r in current(spark, manifest_path).select("chunk").collect()}
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("chunk=") and name[len("chunk="):] not in owned:
            fs.delete(s.getPath(), True)


def missing_ranges(ranges: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of :func:`~quantlake.sources.sinks.expand_ranges` for which the manifest holds no file of that range's name."""
    start, end, _ = filename_range(F.regexp_replace("file", "%20", " "))
    have = manifest.select(start.alias("start"), end.alias("end")).distinct()
    return ranges.join(have, ["start", "end"], "left_anti")
