"""Periodic run detection: Baier grouping, Lyndon roots, extension to runs.

The first phase of Baier's suffix sorter deals suffixes into groups by their
longest Lyndon prefix; done under an order of the words and under its reverse, it
gives both Lyndon arrays without a suffix array.  Every run holds a Lyndon root of
its period under one of the two orders, so each (place, Lyndon length) is a
candidate, and its common extensions to both sides give the run.

Words are compared as they are: hashes only cut out words that are too rare for any
run and bound the extensions, and every run is checked word by word.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: Beyond so many words Baier's tables are typed arrays instead of lists (a fifth of the memory, somewhat slower).
_LONG = 1 << 18


def lyndon_lengths(ids: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place, smaller ids first; linear in len(ids).

    Groups are worked off from the greatest to the smallest.  A place's ``back``
    is the nearest place before it in a smaller group; the places that l members of the
    group point back to move, with l copies of the group's word appended to their
    own, into a new group right above their old one.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    cut = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
    n_groups = len(cut)
    members = [m.tolist() for m in np.split(order, cut[1:])]
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(np.arange(n_groups), np.diff(np.append(cut, n)))
    def table(v):
        return v.tolist() if n <= _LONG else array("q", v.astype(np.int64).tobytes())
    group, back, found = table(rank), table(np.zeros(n, np.int64)), table(np.zeros(n, np.int64))
    done = bytearray(n)
    word = [1] * n_groups                                   # length of the group's Lyndon word
    below = list(range(-1, n_groups - 1))
    above = [*range(1, n_groups), -1]
    g = n_groups - 1
    while g >= 0:
        size = word[g]
        moves: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for s in members[g]:
            if group[s] != g:
                continue                                    # moved up since
            found[s] = size
            p = s - 1
            while p >= 0 and done[p]:
                p = back[p]
            back[s] = p
            done[s] = 1
            if p == last:
                times += 1
            else:
                if last >= 0:
                    moves.setdefault((times, group[last]), []).append(last)
                last, times = p, 1
        if last >= 0:
            moves.setdefault((times, group[last]), []).append(last)
        members[g] = ()
        for times, old in sorted(moves, reverse=True):      # more copies of the word: further up
            new = len(word)
            moved = moves[times, old]
            members.append(moved)
            word.append(word[old] + times * size)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            for p in moved:
                group[p] = new
        g = below[g]
    return np.array(found, dtype=np.int64)


def _extension(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For places a < b the length of the common stretch from both on, by binary search over span hashes."""
    lo, hi = np.zeros(len(a), np.int64), len(h) - b
    while len(a) and (lo < hi).any():
        mid = (lo + hi + 1) >> 1
        same = T.span_hashes(h, a, a + mid) == T.span_hashes(h, b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def _scan(ids: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch of period q around [i, i + q), word by word (only where a hash has misled)."""
    s, e = i, i + q
    while s > 0 and ids[s - 1] == ids[s - 1 + q]:
        s -= 1
    while e < len(ids) and ids[e] == ids[e - q]:
        e += 1
    return s, e


def find_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """(start, length, period) of every run of length >= max(min_length, min_exponent * period), by start, then period.

    min_exponent is 2 at least, as below that a stretch need not hold a whole Lyndon root.
    """
    n = len(ids)
    places = np.arange(n)
    at, period = [], []
    for key in (ids, ids.max(initial=0) - ids):
        q = lyndon_lengths(key)
        ok = np.flatnonzero(places + q < n)
        ok = ok[ids[ok] == ids[ok + q[ok]]]
        at.append(ok)
        period.append(q[ok])
    at, period = np.concatenate(at), np.concatenate(period)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    key = np.unique(period * (n + 1) + at)
    period, at = key // (n + 1), key % (n + 1)
    h = T.mix(ids.astype(np.uint64) + T.U(0x9E3779B97F4A7C15))
    right = _extension(h, at, at + period)
    # common stretch to the left of both places: the same question on the reversed sequence
    left = _extension(h[::-1].copy(), n - at - period, n - at)
    start, end = at - left, at + period + right
    long = end - start >= np.maximum(min_length, min_exponent * period)
    _, one = np.unique(np.stack([start[long], end[long], period[long]]), axis=1, return_index=True)     # a run's roots all give the run
    out = set()
    for s, e, i, q in zip(*(v[long][one].tolist() for v in (start, end, at, period))):
        if not (np.array_equal(ids[s:e - q], ids[s + q:e])):
            s, e = _scan(ids, i, q)
            if e - s < max(min_length, min_exponent * q):
                continue
        out.add((s, e - s, q))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)


def _worth_a_look(h: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Places that a run may hold: each word of a run occurs min_exponent times in it.

    Rarer words cut a text into segments, in which words are counted again, until
    nothing changes.  No run crosses or touches a place that is cut out.
    """
    left = np.arange(len(h))
    seg = doc
    while len(left):
        # unequal words with one hash are counted together, which only keeps more
        _, which, count = np.unique(T.mix(h[left] + T.mix(seg.astype(np.uint64) + T.U(1))), return_inverse=True, return_counts=True)
        stay = count[which] >= min_exponent
        new = left[stay]
        start = np.concatenate([[True], (np.diff(new) != 1) | (np.diff(doc[new]) != 0)]) if len(new) else np.zeros(0, bool)
        seg = np.cumsum(start)
        size = np.bincount(seg)[seg] if len(new) else np.zeros(0, np.int64)
        shorter = size < min_length
        new, seg = new[~shorter], seg[~shorter]
        if len(new) == len(left):
            break
        left = new
    return left


def _of_batch(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> pa.RecordBatch:
    buf, bounds = T.joined(batch.column(1))
    starts, ends = T.word_spans(buf)
    first = T.per_text(starts, bounds)
    doc = T.doc_of(first)
    left = _worth_a_look(T.word_hashes(buf, starts, ends), doc, min_length, min_exponent)
    runs: list[list[dict]] = [[] for _ in range(batch.num_rows)]
    drops: dict[int, np.ndarray] = {}
    if len(left):
        raw = buf.tobytes()
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(raw[s:e], len(known)) for s, e in zip(starts[left].tolist(), ends[left].tolist())], dtype=np.int64)
        # segments in a row, a word of its own between them
        gap = np.flatnonzero((np.diff(left) != 1) | (np.diff(doc[left]) != 0)) + 1
        seq = np.insert(ids, gap, len(known) + np.arange(len(gap)))
        place = np.insert(left, gap, -1)
        for s, length, q in find_runs(seq, min_length, min_exponent).tolist():
            at = int(place[s])
            d = int(doc[at])
            at -= int(first[d])
            runs[d].append({"start": at, "length": length, "period": q})
            gone = drops.setdefault(d, np.zeros(int(first[d + 1] - first[d]), dtype=bool))
            gone[at + q:at + length] = True
    kept = []
    for i, text in enumerate(batch.column(1).to_pylist()):
        words = (text or "").encode().split()               # bytes.split() splits at blank and 0x09-0x0D
        if i in drops:
            words = [w for w, g in zip(words, drops[i].tolist()) if not g]
        kept.append(b" ".join(words))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(np.diff(first), pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "kept_text"])


def detect(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Runs of every document's words (maximal stretches without blanks and 0x09-0x0D), and the text without repeats.

    Returns doc_id, n_words, runs (start word, length in words, smallest period; by
    start, then period) and kept_text: the words left when each run keeps its first
    period only, joined by one space.  Every row is judged on its own, in the task
    that reads it, without a shuffle; rows that repeat an id come back as often.  A null
    or empty text has 0 words, no runs and an empty kept_text; a null id stays
    null.  Other columns are not read.  Work grows linearly with a text, however long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches):
            yield _of_batch(b, min_length, min_exponent)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, one document of ten (by the checksum of its id) with its tail replaced by copies of a stretch.

    With h = crc32(id), g = h div 10 and n words, in a document with h mod 10 = 0 every
    word i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for i, h in enumerate(b.column(2).to_pylist()):
                words = (texts[i] or b"").split() if h is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    real = F.col("doc_id").cast("long")
    return docs.select(real.alias("doc_id"), F.col("text").cast("string").alias("text"), F.crc32(real.cast("string").cast("binary")).alias("h")) \
        .mapInArrow(run, "doc_id long, text string")


def digests(found: DataFrame) -> DataFrame:
    """One row a document of :func:`detect`: number of runs, the most periodic run, digests of all runs and of the kept text."""
    best = F.aggregate("runs", F.expr("CAST(NULL AS struct<start:long,length:long,period:long>)"),
                       lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    d = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                     F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.coalesce(F.col("kept_text"), F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"),
                    F.expr("(1000 * b.length) div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
