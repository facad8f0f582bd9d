"""Delta-maintained token counts by source, language and tokenizer version.

A change of a document is a signed row: an insert adds its documents and
tokens, a delete takes them away, a revised count does both.  A batch is
rolled up to additive deltas per group and committed once under its id: its
folder appears by Spark's own commit and holds its _SUCCESS file only then, so
a batch that is sent again, or whose job died half-way, changes nothing twice.  Totals are the
sum of the committed deltas.

Groups are summed before the shuffle, so a source that holds a third of all
rows costs one row a task.

Defined results: null text counts as empty (0 tokens); null source or
language is a group of its own; repeated rows count each; groups whose
documents and tokens are both 0 vanish; no batches give no totals.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packing
from . import textops as T

GROUP = ("source", "lang", "tokenizer_version")
SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


def count_tokens(docs: DataFrame, tokenizers: dict[str, str | None]) -> DataFrame:
    """doc_id, text_hash, source, lang, tokenizer_version, n_tokens of every whole text and tokenizer.

    tokenizers: version to the vocabulary's path, or None for words parted by white space.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("text_hash"),
                      F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", "text_hash", "source", "lang"]

    def run(batches):
        for piece in T.slices(batches):
            texts = [t or "" for t in piece.column(4).to_pylist()]
            for version, path in tokenizers.items():
                if path is None:
                    buf, bounds = T.joined(piece.column(4))
                    n = np.diff(T.per_text(T.word_spans(buf)[0], bounds))
                else:
                    n = np.array([len(x) // 4 for x in packing.tokenizer(path)(texts)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([*piece.columns[:4], pa.array([version] * len(texts), pa.string()), pa.array(n)],
                                                 names=[*names, "tokenizer_version", "n_tokens"])

    return own.mapInArrow(run, "doc_id long, text_hash string, source string, lang string, tokenizer_version string, n_tokens long")


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*GROUP, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*GROUP, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed counts of the same documents: the old rows leave, the new ones come."""
    return deletes(old).union(inserts(new))


class Rollup:
    """Totals kept as committed batches of deltas under one folder of the shared store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def _folders(self) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(str(f.getPath().toString()) for f in fs.listStatus(p)) if fs.exists(p) else []

    def committed(self) -> list[str]:
        return [f for f in self._folders() if self._exists(f"{f}/_SUCCESS")]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows; False, and nothing done, if this id is in already."""
        folder = f"{self.path}/batch={batch_id}"
        if self._exists(f"{folder}/_SUCCESS"):
            return False
        (changes.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .where("n_docs <> 0 OR n_tokens <> 0").write.mode("overwrite").parquet(folder))
        return True

    def totals(self) -> DataFrame:
        parts = [self.spark.read.schema(SCHEMA).parquet(f) for f in self.committed()]
        rows = reduce(DataFrame.union, parts, self.spark.createDataFrame([], SCHEMA))
        return (rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs <> 0 OR n_tokens <> 0"))
