"""Structured Streaming forms of the chunk loader (our extension; the reference is batch).

* :func:`stream_promote` — file-source stream, each micro-batch is landed once,
  checked (D1–D6), gated and promoted by the batch anti join; a ledger by batch id
  makes a replayed batch a no-op; checkpointed.
* :func:`stream_dedupe` — bounded streaming dedupe on the natural key with a
  watermark (``dropDuplicatesWithinWatermark``).
* :func:`stream_qc` — tumbling-window QC metrics, append mode; :func:`seal` ends a
  finite input and so closes the windows that its watermark left open.
* :func:`stream_link` — stream ⨝ static interval table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType

from quantlake.operators import promote as P
from quantlake.operators import quality as Q
from quantlake.operators.intervals import interval_join
from quantlake.session import materialize, path_exists, scratch_path


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A file-source stream with a declared schema (no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def ledger_path(checkpoint: str) -> str:
    """Where :func:`stream_promote` keeps the record of the batches of a checkpoint."""
    return checkpoint.rstrip("/") + "-ledger"


def stream_promote(stream: DataFrame, main_path: str, key: Sequence[str], checkpoint: str,
                   qc_path: str | None = None, date_cols: Sequence[str] = (), dedupe_within: bool = True,
                   order: Sequence[str] | None = None, prune_on: str | None = None, null_rules: Mapping[str, Column] | None = None,
                   value_col: str | None = None, code_cols: Sequence[str] = (), thresholds: Mapping | None = None) -> StreamingQuery:
    """Promote every micro-batch into the Parquet table at ``main_path``.

    A batch is evaluated once: its rows are landed with a flag that says whether their key is
    in main already.  From that table come

    * the QC row (D1; with ``value_col`` D2–D5 as in :func:`~quantlake.operators.quality.staging_qc`;
      D6 as ``rows_already_in_main``), written to ``qc_path/batch_id=N``;
    * the gate (D8): a batch that breaks one of ``thresholds`` (by ``("batch", metric)``) is recorded and not promoted;
    * the rows whose key is new (duplicates inside the batch collapsed when ``dedupe_within``), appended to main.

    Last, the batch's row goes into the ledger (:func:`ledger_path`: rows staged, already in
    main, promoted, and whether the gate passed).  A batch that is in the ledger is skipped without
    reading main; one that failed between the append and the ledger finds its keys in main and
    appends nothing.  The ledger belongs to the checkpoint, whose batch ids it holds.
    ``prune_on`` limits the main side of the join to the batch's range of that key column.
    """
    schema = stream.schema
    ledger = ledger_path(checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        entry = f"{ledger}/batch_id={batch_id}"
        if path_exists(spark, f"{entry}/_SUCCESS"):
            return
        main = P.read_or_empty(spark, main_path, schema)
        landing = scratch_path(spark, f"batch-{batch_id}")
        batch.write.mode("overwrite").parquet(landing)
        # keys and flag are one more column of the landed rows, which are read from here on
        landed = materialize(P.tagged(spark.read.schema(schema).parquet(landing), main, key, prune_on), f"tagged-{batch_id}")
        wide = Q.staging_qc(landed, list(date_cols), null_rules or {}, value_col, list(code_cols), list(key)) if value_col \
            else Q.row_count_and_range(landed, list(date_cols), check=None)
        # one row each, no key between them
        overlap = landed.agg(F.count_if("_in_main").alias("rows_already_in_main"))
        qc = wide.withColumn("rows_already_in_main", overlap.scalar())
        if qc_path:
            # a folder for each batch id: a replayed batch replaces its own row
            qc.write.mode("overwrite").parquet(f"{qc_path.rstrip('/')}/batch_id={batch_id}")
            qc = spark.read.parquet(f"{qc_path.rstrip('/')}/batch_id={batch_id}")
        passed = not thresholds or Q.gate(Q.tidy(qc, "batch"), thresholds).where(~F.col("passed")).isEmpty()
        new = landed.where(~F.col("_in_main")).select(*schema.names)
        if dedupe_within:
            new = Q.keep_one(new, list(key), list(order or schema.names))
        new = materialize(new, f"new-{batch_id}") if passed else new.limit(0)
        if passed:
            new.write.mode("append").parquet(main_path)
        row = qc.select(F.col("rows").alias("rows_staged"), "rows_already_in_main").withColumns(
            {"rows_promoted": new.agg(F.count(F.lit(1))).scalar(), "passed": F.lit(passed)})
        row.coalesce(1).write.mode("overwrite").parquet(entry)

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def event_time(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need ``TIMESTAMP``: a ``TIMESTAMP_NTZ`` wall time becomes that instant in UTC.

    ``convert_timezone`` keeps this independent of the session time zone, so
    tumbling windows (aligned to UTC) match wall-clock days in any session.
    """
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        return df.withColumn(time, F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(time))
                             .cast("timestamp"))
    return df


def wall_time(c: Column) -> Column:
    """Inverse of :func:`event_time`: an instant back to its UTC wall time (``TIMESTAMP_NTZ``)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def stream_dedupe(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key seen within ``delay`` of event time (bounded state)."""
    ntz = isinstance(stream.schema[time].dataType, TimestampNTZType)
    out = event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))
    return out.withColumn(time, wall_time(F.col(time))) if ntz else out


_SEAL_SCHEMA = "sealed timestamp"
# fixed value: an event time behind every other, so that the watermark passes all of them
_END_OF_TIME = "9999-12-01 00:00:00"


def open_control(spark: SparkSession, control: str) -> str:
    """An empty control folder for :func:`stream_qc`; a folder that is there already stays as it is."""
    if not path_exists(spark, control):
        spark.createDataFrame([], _SEAL_SCHEMA).write.parquet(control)
    return control


def seal(spark: SparkSession, control: str) -> None:
    """Say that a stream's input is complete: its next run closes all windows; rows that come later are late."""
    spark.sql(f"SELECT timestamp_seconds({_seconds(_END_OF_TIME)}) AS sealed").write.mode("append").parquet(control)


def _seconds(utc: str) -> int:
    return int(dt.datetime.fromisoformat(utc).replace(tzinfo=dt.timezone.utc).timestamp())


def stream_qc(stream: DataFrame, time: str, width: str, delay: str, value: str,
              by: Sequence[str] = (), control: str | None = None) -> DataFrame:
    """Per tumbling window: rows, NULL share of ``value``, min/max ``value``.

    Append mode: a window is emitted once the watermark passes its end.  So the last
    windows of a finite input stay open, in the query's state.  With a ``control`` folder
    (:func:`open_control`) the stream can be sealed: run the input, call :func:`seal`, run the same query from
    the same checkpoint again, and the mark moves the watermark past all open
    windows, which are emitted from the state; no input is read again.
    """
    ntz = isinstance(stream.schema[time].dataType, TimestampNTZType)
    edge = (lambda c: wall_time(c)) if ntz else (lambda c: c)
    rows = event_time(stream, time).select(F.col(time).cast("timestamp").alias(time), F.col(value), *by, F.lit(False).alias("_mark"))
    if control is not None:
        marks = stream.sparkSession.readStream.schema(_SEAL_SCHEMA).parquet(control)
        rows = rows.unionByName(marks.select(F.col("sealed").alias(time), F.lit(True).alias("_mark")), allowMissingColumns=True)
    real = ~F.col("_mark")
    n = F.count_if(real)
    out = (rows.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *by)
               .agg(n.alias("rows"),
                    F.round(F.try_divide(F.count_if(real & F.col(value).isNull()).cast("double"), n.cast("double")), 4).alias("pct_null"),
                    F.min(value).alias("minv"), F.max(value).alias("maxv")))
    return out.where("rows > 0").select(edge(F.col("w.start")).alias("window_start"), edge(F.col("w.end")).alias("window_end"), *by,
                                        "rows", "pct_null", "minv", "maxv")


def stream_link(stream: DataFrame, link: DataFrame, on: Sequence[str], at: str, start: str, end: str,
                dim_cols: Sequence[str] | None = None, how: str = "left") -> DataFrame:
    """Enrich a stream with a static validity-interval table (stream–static join)."""
    return interval_join(stream, link, list(on), at, start, end, how=how, dim_cols=dim_cols)


def to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a streaming frame to a Parquet sink until the available input is consumed."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .outputMode(mode).trigger(availableNow=True).start())
