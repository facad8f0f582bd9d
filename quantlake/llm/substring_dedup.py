"""Removal of words in repeated windows, by difference-cover anchors.

Two equal windows of SPAN words at positions p and q share an anchor: for any
p and q some shift below PERIOD puts both p + shift and q + shift on positions that are in
COVER modulo PERIOD.  So only the short windows (SPAN - PERIOD + 1 words) at cover positions are
hashed and exchanged; anchors that occur once end there.  Around the others,
the windows that contain them are extended to the full SPAN words, hashed with 96
bits and grouped; all but the earliest (document, position) of a group are
repeats.

Data flow: documents -> anchors by hash -> repeated anchors by document ->
full windows by hash -> repeated windows by document -> results.  A task
sends each anchor or window hash once, with the earliest place of its own
documents, so a passage that a third of all documents hold costs one entry a
task.  Places travel packed; texts are shuffled once, by document.

Defined results: null texts have no words; a null doc_id comes after all
others; rows that repeat a doc_id are one document (place = id and position), so
exact repeated rows all stay or go alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange as X
from . import textops as T

SPAN, PERIOD = 20, 13
#: A difference cover modulo 13: every residue is a difference of two members.
COVER = (0, 1, 3, 9)

_PLACES = {"doc": "<i8", "pos": "<i4"}
#: Five bytes of the hash; the part tells more of it, and an accidental match only costs an extension.
_ANCHORS = {**_PLACES, "h": "u5"}
_WINDOWS = {**_PLACES, "h": "<u8", "g": "<u4"}


class Words:
    """Words of a run of texts: spans in the joined buffer, first word of each text, hashes."""

    def __init__(self, texts: pa.Array, which: tuple[int, ...] = (0,)):
        self.buf, bounds = T.joined(texts)
        self.starts, self.ends = T.word_spans(self.buf)
        self.first = T.per_text(self.starts, bounds)
        self.hashes = [T.word_hashes(self.buf, self.starts, self.ends, w) for w in which]


def anchors(texts: pa.Array, span: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the anchors: windows of span - period + 1 words at cover positions."""
    w = Words(texts)
    at, h = T.windows(w.hashes[0], w.first, span - period + 1)
    doc = T.doc_of(w.first)[at] if len(at) else at
    pos = at - w.first[doc]
    member = np.zeros(period, dtype=bool)
    member[list(cover)] = True
    take = member[pos % period]
    return doc[take], pos[take], h[take]


def _first_of(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each entry in sorted order, the index (in sorted order) at which its group begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order


def _in_groups(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Entries (original index) whose group has two members or more."""
    if not len(order):
        return order
    ends = np.append(new[1:], True)
    return order[~(new & ends)]


def dedup(docs: DataFrame, span: int = SPAN, period: int = PERIOD, cover: tuple[int, ...] = COVER,
          carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every document, and ``carried`` columns of its row."""
    if period >= span or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover modulo a period below the span")
    parts, buckets = X.sizes(docs)
    own = X.bucketed(docs, buckets)

    def part_of(h):
        return (h >> T.U(40)).astype(np.int64) % parts

    def bypass(doc):
        """Entries that need no partner: a part below zero for each bucket, so nothing meets in one place."""
        return -1 - X.buckets_of(doc, buckets)

    def send_anchors(batches):
        for piece in T.slices(batches):
            ids = piece.column(0).to_numpy()
            doc, pos, h = anchors(piece.column(1), span, period, cover)
            doc = ids[doc]
            order, new = X.repeated(h)
            known = _in_groups(order, new)                    # these repeat among this task's own texts
            yield X.rows("part", bypass(doc[known]), _ANCHORS, [doc[known], pos[known], h[known]])
            once = np.sort(order[new])
            yield X.rows("part", part_of(h[once]), _ANCHORS, [doc[once], pos[once], h[once]])

    def find_anchors(key: tuple, table: pa.Table) -> pa.Table:
        doc, pos, h = X.entries(table, _ANCHORS)
        if key[0].as_py() >= 0:
            some = _in_groups(*X.repeated(h))
            doc, pos = doc[some], pos[some]
        return X.tables([X.rows("bucket", X.buckets_of(doc, buckets), _PLACES, [doc, pos])], "bucket", _PLACES)

    def send_windows(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        doc, pos = X.entries(found, _PLACES)
        if not len(doc) or not texts.num_rows:
            return X.tables([], "part", _WINDOWS)
        out = []
        for piece in T.slices(texts.combine_chunks().to_batches()):
            ids = piece.column(0).to_numpy()
            w = Words(piece.column(1), (0, 1))
            row, at = X.by_row(ids, doc, pos)
            near = np.zeros(len(w.starts) + 1, dtype=np.int32)   # +1 where windows that hold an anchor begin, -1 past them
            at = at + w.first[row]
            fits = at < w.first[row + 1]
            row, at = row[fits], at[fits]
            np.add.at(near, np.maximum(at - (period - 1), w.first[row]), 1)
            np.add.at(near, at + 1, -1)
            at = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            text = T.doc_of(w.first)
            at = at[at + span <= w.first[text[at] + 1]]
            h, g = (T.span_hashes(x, at, at + span, k) if len(at) else np.zeros(0, np.uint64) for k, x in enumerate(w.hashes))
            g = g & T.U(0xFFFFFFFF)
            d, p = ids[text[at]], at - w.first[text[at]]
            by_place = np.lexsort((p, d))
            h, g, d, p = h[by_place], g[by_place], d[by_place], p[by_place]
            order, new = X.repeated(h, g)
            lead = order[_first_of(order, new)]
            later = order[(d[order] > d[lead]) | (p[order] > p[lead])]
            out.append(X.rows("part", bypass(d[later]), _WINDOWS, [d[later], p[later], h[later], g[later]]))
            once = order[new]
            out.append(X.rows("part", part_of(h[once]), _WINDOWS, [d[once], p[once], h[once], g[once]]))
        return X.tables(out, "part", _WINDOWS)

    def find_windows(key: tuple, table: pa.Table) -> pa.Table:
        doc, pos, h, g = X.entries(table, _WINDOWS)
        if key[0].as_py() >= 0:
            order, new = X.repeated(h, g, doc, pos)[0], X.repeated(h, g)[1]
            lead = order[_first_of(order, new)]
            later = order[(doc[order] > doc[lead]) | (pos[order] > pos[lead])]
            doc, pos = doc[later], pos[later]
        return X.tables([X.rows("bucket", X.buckets_of(doc, buckets), _PLACES, [doc, pos])], "bucket", _PLACES)

    def finish(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        doc, pos = X.entries(found, _PLACES)
        out = []
        for piece in T.slices(texts.combine_chunks().to_batches()):
            ids = piece.column(0).to_numpy()
            buf, bounds = T.joined(piece.column(1))
            starts, ends = T.word_spans(buf)
            first = T.per_text(starts, bounds)
            row, at = X.by_row(ids, doc, pos)
            at = at + first[row]
            fits = at + span <= first[row + 1]
            cover_ = np.zeros(len(starts) + 1, dtype=np.int32)
            np.add.at(cover_, at[fits], 1)
            np.add.at(cover_, at[fits] + span, -1)
            gone = np.cumsum(cover_[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            data = buf.tobytes()
            kept = []
            starts_, ends_, first_ = starts, ends, first.tolist()
            for a, b in zip(first_, first_[1:]):
                stay = a + np.flatnonzero(~gone[a:b])
                kept.append(b" ".join([data[s:e] for s, e in zip(starts_[stay].tolist(), ends_[stay].tolist())]))
            absent = piece.column(2).to_numpy(zero_copy_only=False)
            out.append(pa.RecordBatch.from_arrays([
                pa.array(ids, mask=absent), pa.array(np.diff(first)), pa.array(total[first[1:]] - total[first[:-1]]),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()),
                *piece.columns[4:]], names=[*_RESULT, *piece.schema.names[4:]]))
        return pa.Table.from_batches(out) if out else pa.schema([*_RESULT.items(), *list(texts.schema)[4:]]).empty_table()

    place = X.schema("bucket", _PLACES)
    found = own.select("doc_id", "text").mapInArrow(send_anchors, X.schema("part", _ANCHORS)).groupBy("part").applyInArrow(find_anchors, place)
    grouped = X.bucketed(docs, buckets, carry)
    windows = (grouped.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(send_windows, X.schema("part", _WINDOWS))
               .groupBy("part").applyInArrow(find_windows, place))
    return (grouped.groupBy("bucket").cogroup(windows.groupBy("bucket"))
            .applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string" + X.carried_type(docs, carry)))


_RESULT = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}
