"""Packed rows: many fixed-width entries that go to one partition travel as one row of binary columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for which one group of entries (part) and one group of documents (bucket) are planned.
PART_BYTES, BUCKET_BYTES = 4 << 20, 2 << 20
NO_ID = np.iinfo(np.int64).max


def schema(key: str, cols: dict[str, str]) -> str:
    return f"{key} int, " + ", ".join(f"{c} binary" for c in cols)


def _raw(v: np.ndarray, kind: str) -> tuple[bytes, int]:
    if kind == "u5":                       # the low five bytes of a hash
        return np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), 5
    v = np.ascontiguousarray(v.astype(kind))
    return v.tobytes(), v.dtype.itemsize


def rows(key: str, part: np.ndarray, cols: dict[str, str], values: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each value of part, its entries in their order; cols: name to numpy type."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(part))
    arrays = [pa.array(part[cut].astype(np.int32))]
    for (name, kind), v in zip(cols.items(), values):
        data, size = _raw(v[order], kind)
        arrays.append(pa.array([data[size * a:size * b] for a, b in zip(cut.tolist(), ends.tolist())], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=[key, *cols])


def entries(table: pa.Table, cols: dict[str, str]) -> list[np.ndarray]:
    """The entries of all rows, one array a column."""
    out = []
    for c, kind in cols.items():
        data = b"".join(table.column(c).to_pylist())
        if kind == "u5":
            wide = np.zeros((len(data) // 5, 8), dtype=np.uint8)
            wide[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
            out.append(wide.view("<u8").ravel())
        else:
            out.append(np.frombuffer(data, dtype=kind))
    return out


def tables(batches: list[pa.RecordBatch], key: str, cols: dict[str, str]) -> pa.Table:
    empty = pa.schema([(key, pa.int32()), *((c, pa.binary()) for c in cols)])
    return pa.Table.from_batches(batches, empty) if batches else empty.empty_table()


def sizes(docs: DataFrame) -> tuple[int, int]:
    """(parts, buckets) planned for the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(32, -(-total // PART_BYTES)), max(32, -(-total // BUCKET_BYTES))


def _struct(docs: DataFrame, carry: list[str]):
    """The columns as one struct whose fields may all be null, as those that come back from a task are."""
    own = F.struct(*carry)
    return own.cast(docs.select(own.alias("c")).schema["c"].dataType.simpleString())


def bucketed(docs: DataFrame, buckets: int, carry: list[str] | None = None) -> DataFrame:
    """doc_id, text, no_id, bucket, and where asked for a struct ``carried`` of other columns; a null id is the last of all."""
    text, real = F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long")
    rest = [_struct(docs, carry).alias("carried")] if carry else []
    return (docs.select(F.coalesce(real, F.lit(int(NO_ID))).alias("doc_id"), text, real.isNull().alias("no_id"), *rest)
            .select("doc_id", "text", "no_id", bucket_of(F.col("doc_id"), buckets).alias("bucket"), *(["carried"] if carry else [])))


def carried_type(docs: DataFrame, carry: list[str] | None) -> str:
    """The struct's column for a result schema, with its comma."""
    return f", carried {docs.select(F.struct(*carry).alias('c')).schema['c'].dataType.simpleString()}" if carry else ""


def bucket_of(doc_id, buckets: int):
    return F.pmod(doc_id.bitwiseXOR(F.shiftrightunsigned(doc_id, 17)), F.lit(buckets)).cast("int")


def buckets_of(doc_id: np.ndarray, buckets: int) -> np.ndarray:
    """As bucket_of, in numpy."""
    u = doc_id.astype(np.int64).view(np.uint64)
    return np.mod((u ^ (u >> np.uint64(17))).view(np.int64), buckets)


def by_row(ids: np.ndarray, doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, value...) for every entry (doc, value) and every row that holds its document; sorted by row."""
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    lo, hi = np.searchsorted(doc, ids, side="left"), np.searchsorted(doc, ids, side="right")
    n = hi - lo
    row = np.repeat(np.arange(len(ids)), n)
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return (row, *(v[order][at] for v in values))


def repeated(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group starts): entries sorted by the keys (first key first; equal keys in entry order) and where groups begin."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    return order, new
