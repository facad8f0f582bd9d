"""Corpus pipeline: toxicity, near duplicates, repeated passages, secrets, packing.

Every stage takes the documents that the one before it kept, whole, and (but for
the last, which returns the packed pieces) gives back the columns of
``documents``.  Between stages the rows are written as Parquet to the shared
folder and read again, so a lost executor repeats a part of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.llm import jaccard_join, packing, secret_scan, suffix_dedup, toxicity
from quantlake.session import materialize

#: SQL cannot express the learned and the packing stages; tests compare every stage with a plain version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model learns from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every group linked by word 5-grams at 0.8 or more.

    Rows that repeat a doc_id leave the row by whose text the id was judged; rows without an id cannot be told apart and stay.
    """
    found = jaccard_join.near_duplicates(docs, k=5, num=4, den=5, links=False)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").select(*docs.columns)
    twice = materialize(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if twice.first() is not None:
        named = named.join(twice, "doc_id", "left_anti").select(*docs.columns).union(
            jaccard_join.judged_rows(named.join(twice, "doc_id", "left_semi").select(*docs.columns), k=5))
    return named.union(docs.where("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its bytes that a 100-byte string of an earlier place covers; no document goes."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = suffix_dedup.dedup(docs, carry=rest or None)
    cut = F.col("n_removed") > 0
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"),
           "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars")) if "n_chars" in rest else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col(f"carried.{c}")).alias(c) for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its secrets masked, but for values that several owners copy."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", one_of_near_duplicates), ("suffix_array_dedup", cut_repeats),
          ("secret_scans", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the pieces of the last."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
