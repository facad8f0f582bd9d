"""Quality rules as a short-circuit cascade.

Base figures are computed for every document.  The rules that follow them run
in order of rejections per second, both estimated on a bounded sample, and a
document leaves the cascade at the first rule that rejects it; the order
changes the time, never the verdict.

Defined results: a null or empty text has zero figures, fails the base test
and is not kept; repeated rows give repeated results; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

#: Characters that count as symbols: [#*$%&|<>].
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC2, 256)]] = True     # lead bytes count as letters
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_ASCII_LETTER = _UPPER.copy()
_ASCII_LETTER[97:123] = True
_POINT = np.ones(256, dtype=bool)
_POINT[0x80:0xC0] = False


def _sums(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[hi] - total[lo]


class Batch:
    """Figures of a run of texts; each is computed when it is first asked for, over the rows asked for."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.buf, self.bounds = T.joined(texts)
        self.starts, self.ends = T.word_spans(self.buf)
        self.first = T.per_text(self.starts, self.bounds)
        self.n = len(texts)
        self.n_words = np.diff(self.first)
        self._hash = None

    def hashes(self) -> np.ndarray:
        if self._hash is None:
            self._hash = T.word_hashes(self.buf, self.starts, self.ends)
        return self._hash

    def base(self) -> dict[str, np.ndarray]:
        lo, hi = self.bounds[:-1], self.bounds[1:] - 1
        space = T.SPACE[self.buf]
        out = {"n_words": self.n_words, "word_chars": _sums(_POINT[self.buf] & ~space, lo, hi),
               "n_symbols": _sums(SYMBOLS[self.buf], lo, hi)}
        cut = np.flatnonzero(self.buf == 10)
        begin = np.concatenate([[0], cut[:-1] + 1]) if len(cut) else cut
        has_word = np.searchsorted(self.starts, cut) > np.searchsorted(self.starts, begin)
        begin, cut = begin[has_word], cut[has_word]
        doc = np.searchsorted(self.bounds, begin, side="right") - 1
        lines = np.bincount(doc, minlength=self.n)
        keys = T.mix(T.word_hashes(self.buf, begin, cut) + T.mix(doc.astype(np.uint64)))
        _, at = np.unique(keys, return_index=True)
        out["n_dup_lines"] = lines - np.bincount(doc[at], minlength=self.n)
        self.n_lines = lines
        at, h = T.windows(self.hashes(), self.first, 3)
        doc = T.doc_of(self.first)
        covered = np.zeros(len(self.starts) + 2, dtype=bool)
        if len(at):
            h = T.mix(h + T.mix(doc[at].astype(np.uint64)))
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            twice = np.zeros(len(h), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            for j in range(3):
                covered[at[twice] + j] = True
        out["n_repeat_words"] = _sums(covered[:len(self.starts)], self.first[:-1], self.first[1:])
        return out

    def part(self, rows: np.ndarray) -> "Batch":
        return self if len(rows) == self.n else Batch(self.texts.take(pa.array(rows)))

    def share(self, flags: np.ndarray, of: np.ndarray) -> np.ndarray:
        lo, hi = self.bounds[:-1], self.bounds[1:] - 1
        return _sums(flags[self.buf], lo, hi) / np.maximum(1, _sums(of[self.buf], lo, hi))

    def distinct_share(self) -> np.ndarray:
        doc = T.doc_of(self.first)
        _, at = np.unique(T.mix(self.hashes() + T.mix(doc.astype(np.uint64))), return_index=True)
        return np.bincount(doc[at], minlength=self.n) / np.maximum(1, self.n_words)

    def letter_words(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(_LETTER[self.buf], dtype=np.int64)])
        with_letter = (total[self.ends] - total[self.starts]) > 0
        return _sums(with_letter, self.first[:-1], self.first[1:]) / np.maximum(1, self.n_words)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Batch, dict[str, np.ndarray]], np.ndarray]


#: The rules of the cascade; figures is what Batch.base gave, cut to the rows still in it.
RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda b, f: f["n_symbols"] > 0.1 * f["n_words"]),
    Rule("word_length", lambda b, f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 15 * f["n_words"])),
    Rule("repeated_lines", lambda b, f: f["n_dup_lines"] > 0.5 * f["n_lines"]),
    Rule("few_letters", lambda b, f: b.share(_LETTER, _POINT & ~T.SPACE) < 0.5),
    Rule("wordless", lambda b, f: b.letter_words() < 0.7),
    Rule("shouting", lambda b, f: b.share(_UPPER, _ASCII_LETTER) > 0.5),
    Rule("few_distinct", lambda b, f: b.distinct_share() < 0.1),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def rule_order(docs: DataFrame, sample_rows: int = 256, rules: tuple[Rule, ...] = RULES) -> list[str]:
    """Names of the rules by rejections per second on ``sample_rows`` documents (those with the smallest id hash).

    Only ids are sorted; the sampled texts stay in the tasks, which return
    one row for each rule.
    """
    ids = [r[0] for r in docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()]

    def measure(batches):
        spent, gone = dict.fromkeys([r.name for r in rules], 0.0), dict.fromkeys([r.name for r in rules], 0)
        for piece in T.slices(batches):
            b = Batch(piece.column(0))
            f = b.base()
            f["n_lines"] = b.n_lines
            for r in rules:
                t = time.perf_counter()
                gone[r.name] += int(r.rejects(b, f).sum())
                spent[r.name] += time.perf_counter() - t
        yield pa.RecordBatch.from_pydict({"rule": list(spent), "spent": list(spent.values()),
                                          "gone": [float(x) for x in gone.values()]})

    if not ids:
        return [r.name for r in rules]
    found = (docs.where(F.col("doc_id").isin(ids)).select(F.col("text").cast("string").alias("text"))
             .mapInArrow(measure, "rule string, spent double, gone double")
             .groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("gone").alias("gone")).collect())
    worth = {r["rule"]: r["gone"] / max(r["spent"], 1e-9) for r in found}
    return sorted((r.name for r in rules), key=lambda n: (-worth.get(n, 0.0), n))


def quality(docs: DataFrame, order: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by."""
    order = rule_order(docs, rules=rules) if order is None else order
    chosen = sorted(rules, key=lambda r: order.index(r.name))

    def run(batches):
        for piece in T.slices(batches):
            b = Batch(piece.column(1))
            f = b.base()
            f["n_lines"] = b.n_lines
            failed = _failed(f)
            by = np.full(b.n, None, dtype=object)
            by[failed] = "base"
            left = np.flatnonzero(~failed)
            for r in chosen:
                if not len(left):
                    break
                gone = r.rejects(b.part(left), {k: v[left] for k, v in f.items()})
                by[left[gone]] = r.name
                left = left[~gone]
            kept = np.zeros(b.n, dtype=bool)
            kept[left] = True
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *(pa.array(f[k].astype(np.int64)) for k in BASE), pa.array(failed), pa.array(kept),
                 pa.array(by, pa.string())], names=["doc_id", *BASE, "base_failed", "kept", "rejected_by"])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, kept boolean, rejected_by string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
