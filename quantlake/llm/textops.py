"""Vectorised text helpers used inside Spark tasks.

A batch of texts is one byte buffer in which every text is followed by one
newline byte, so words, lines and window hashes of many documents come from a
few numpy passes.  Hashes are polynomial over a random byte table, modulo
2**64, with a final mix.  Such a polynomial maps some long patterned strings (Thue-Morse
words and their complements, from 1024 values on) to one value whatever its base, so words and
lines of more than BLOCK bytes are hashed in blocks, whose mixed hashes are hashed in
turn.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.default_rng(20240607)
_TABLES = _rng.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * U(2) + U(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)          # odd, so invertible modulo 2**64
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

#: Bytes of white space: blank and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text worked off at once; a worker needs about a hundred times as many.
PIECE = 1 << 20
#: Bytes whose words are hashed at once; about forty bytes are held for one.
HASHED = PIECE >> 3
#: Values that one polynomial hash covers at most in a word or line.
BLOCK = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over the word (splitmix64)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i < n."""
    size = 1 << max(16, int(n - 1).bit_length())
    key = (which, size)
    if key not in _POWERS:
        for k in [k for k in _POWERS if k[0] == which]:
            del _POWERS[k]
        base = _BASES[which]
        inverse = pow(base, -1, 2**64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[key] = (out[0], out[1])
    return _POWERS[key]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of values[s:e] for every span, values being uint64; equal content gives an equal hash."""
    n = len(values)
    p, inv = _powers(which, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * p[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * U(0x632BE59BD9B4E019))


def content_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """As span_hashes, for spans of any length: those of more than BLOCK values by the hashes of their blocks."""
    out = span_hashes(values, starts, ends, which)
    long = np.flatnonzero(ends - starts > BLOCK)
    if len(long):
        size = ends[long] - starts[long]
        n = -(-size // BLOCK)
        first = np.cumsum(n) - n
        lo = np.repeat(starts[long], n) + BLOCK * (np.arange(int(n.sum())) - np.repeat(first, n))
        blocks = span_hashes(values, lo, np.minimum(lo + BLOCK, np.repeat(ends[long], n)), which)
        out[long] = mix(content_hashes(blocks, first, first + n, which) + size.astype(np.uint64) * U(0xA0761D6478BD642F))
    return out


def byte_values(buf: np.ndarray, which: int = 0) -> np.ndarray:
    return _TABLES[which][buf]


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): text i is bytes[bounds[i]:bounds[i + 1] - 1], then a newline byte.  Null texts are empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
    bounds = offsets + np.arange(n + 1)
    out = np.empty(int(bounds[-1]), dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[bounds[1:] - 1] = False
    out[keep] = raw
    out[bounds[1:] - 1] = 10
    return out, bounds


def word_spans(buf: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (maximal run without white space); the buffer ends with a newline."""
    inside = np.empty(len(buf) + 1, dtype=bool)
    inside[0] = False
    np.logical_not(space[buf], out=inside[1:])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0, size: int = HASHED) -> np.ndarray:
    """Hash of every word, worked off in pieces of about ``size`` bytes so that memory doesn't follow one long text."""
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + size, side="right")))
        a = starts[lo]
        out[lo:hi] = content_hashes(byte_values(buf[a:ends[hi - 1]], which), starts[lo:hi] - a, ends[lo:hi] - a, which)
        lo = hi
    return out


def per_text(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of each text's first word (and one past the last): words of text i are p[i]:p[i + 1]."""
    return np.searchsorted(starts, bounds)


def windows(hashes: np.ndarray, first: np.ndarray, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index, hash) of every window of k consecutive words inside one text; first as per_text gives it."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)     # words from here to the text's end
    at = np.flatnonzero(left >= k)
    return at, (span_hashes(hashes, at, at + k, which) if len(at) else np.zeros(0, np.uint64))


def doc_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


try:
    _libc = ctypes.CDLL(None)
    _libc.malloc_trim
except (OSError, AttributeError):
    _libc = None


def release() -> None:
    """Give a worker's free memory back to the system, as idle workers of earlier stages stay alive."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``size`` bytes of text (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(column)).cast(pa.large_string())
        ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + size, side="right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi
    release()
