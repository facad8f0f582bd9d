"""Registered queries of this subpackage and, where SQL can express one, its DuckDB oracle."""

from __future__ import annotations

import importlib
import os
import sys
import tempfile
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.session import materialize, scratch_path

from . import (bpe, jaccard_join, oracles, packing, periodic_runs, prefix_trie, quality_mil, quality_rules, secret_scan, substring_dedup, suffix_dedup,
               token_counts, topk, toxicity)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark bring this package to the workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(), "quantlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(ROOT, "quantlake")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), ROOT))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(_table(spark, sf_dir, "documents")).drop("kept_text")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule rejects first depends on the measured order, so that column stays out
    return quality_rules.quality(_table(spark, sf_dir, "documents")).drop("rejected_by")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents")).drop("kept_text")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents, each sent twice.

    All documents come in under a word count; the count is revised to a byte-level
    vocabulary; later copies of a text (a greater doc_id) go.
    """
    docs = _table(spark, sf_dir, "documents")
    words, bpe_50k = "words", "byte_bpe_50k"
    counted = materialize(token_counts.count_tokens(docs, {words: None, bpe_50k: public_tokenizers.path("byte_bpe_50k.json")}), "token-counts")
    old, new = counted.where(F.col("tokenizer_version") == words), counted.where(F.col("tokenizer_version") == bpe_50k)
    first = new.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))
    copies = new.join(first, "text_hash").where("doc_id > first_id")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "token-rollup"))
    batches = {"1-insert": token_counts.inserts(old), "2-revise": token_counts.revisions(old, new), "3-delete": token_counts.deletes(copies)}
    for name, changes in [*batches.items(), *batches.items()]:
        rollup.commit(name, changes)
    return rollup.totals()


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(50)) == 0, k=5)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.detect(periodic_runs.with_repeats(_table(spark, sf_dir, "documents"))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return _pipeline.run(spark, sf_dir)


if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
_pipeline = importlib.import_module("corpus_pipeline")

QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_substring_dedup, op3_quality_rules, op4_packing, op5_suffix_dedup, op6_token_counts, op7_secret_scans,
                                   op8_byte_bpe, op9_toxicity, op10_exact_topk, op11_periodic_runs, op12_prefix_trie, op13_quality_mil, pipeline)}
#: The others are learned, tokenized or byte-wise; tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op1_jaccard_join": oracles.JACCARD, "op2_substring_dedup": oracles.SUBSTRING, "op3_quality_rules": oracles.QUALITY,
    "op7_secret_scans": oracles.SECRETS, "op10_exact_topk": oracles.TOP_K,
}
if _pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = _pipeline.ORACLE_SQL
