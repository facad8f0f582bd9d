"""Sum-of-squares online packing of tokenised documents into fixed-size windows.

Every Spark partition packs its own documents in one pass.  A document's full
windows are cut off; the rest goes, whole, to the fill level that minimises the sum
of squared counts of partially filled windows, looked up in a level array.
When the partition ends, the windows still open are refilled from one another
by cutting, and the last is cut at powers of two, which need no padding.

State is one stack of open windows a level, so a task holds at most the pieces of its
open windows (kept few by the rule) and a retried task repeats its result.

Defined results: a null or empty text packs as the end id alone; repeated rows
are packed once each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

#: Chunks whose ids a worker keeps at most, in two generations (speed only).
CACHE_ENTRIES = 1_200_000
#: Bytes of text whose chunks are looked up together; a worker needs about ten times as many.
PIECE = 8 << 20
#: Closing marks that are looked up apart from their word.
MARKS = ",."
END_ID = 1


def _unsafe(chunk: str) -> bool:
    """Whether a chunk may share a pre-token with its neighbours, or holds what looks like a special token."""
    return not chunk or chunk[0].isspace() or chunk[-1].isspace() or "<|" in chunk


def _marked(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(whether a chunk ends in a letter up to U+017F and one mark, its last byte)."""
    ends = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)
    size, ends = np.diff(ends), ends[1:]
    if not len(data):
        return np.zeros(len(size), dtype=bool), np.zeros(len(size), dtype=np.uint8)
    last, before, lead = (np.where(size >= k, data[np.maximum(ends - k, 0)], 0) for k in (1, 2, 3))
    latin = (lead == 0xC3) & (before != 0x97) & (before != 0xB7) | (lead == 0xC4) | (lead == 0xC5)
    letter = (before | 0x20 >= 97) & (before | 0x20 <= 122) & (before < 128) | latin & (before >= 128) & (before < 192)
    return letter & np.isin(last, np.frombuffer(MARKS.encode(), dtype=np.uint8)), last


class ChunkTokenizer:
    """A byte-level BPE tokenizer that looks each different blank-separated chunk of many texts up once, and remembers its ids.

    A byte-level pre-token starts with at most one blank and never runs
    across a single blank between other characters, so such a text is the
    concatenation of its chunks.  A text with white space in a row or at an
    end, or with what looks like a special token, goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.size[i] = len(token)                    # one character of the byte-level alphabet a byte
        self.young: dict[str, bytes] = {}                # chunks after a blank; two generations
        self.old: dict[str, bytes] = {}
        self.marks = np.zeros(128, dtype=np.uint32)
        for m, x in zip(MARKS, self._encode(list(MARKS))):
            self.marks[ord(m)] = np.frombuffer(x, dtype="<u4")[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of " " + each chunk, a thousand chunks in a text; their ends are where the tokens' bytes add up to them."""
        out = []
        sizes = (1 + pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy()).astype(np.int64)
        for k in range(0, len(chunks), 1000):
            packed = self._encode([" " + " ".join(chunks[k:k + 1000])])[0]
            ends = np.cumsum(self.size[np.frombuffer(packed, dtype="<u4")])
            cut = (4 * (np.searchsorted(ends, np.cumsum(sizes[k:k + 1000])) + 1)).tolist()
            out += [packed[x:y] for x, y in zip([0, *cut], cut)]
        return out

    def _known(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of " " + each of different chunks; None for what cannot be split off safely."""
        if len(self.young) > CACHE_ENTRIES // 2:
            self.old, self.young = self.young, {}
        ids = list(map(self.young.get, chunks))
        missing = [i for i, x in enumerate(ids) if x is None]
        fresh = []
        for i in missing:
            w = chunks[i]
            x = self.old.get(w)
            if x is not None:
                ids[i] = self.young[w] = x
            elif not _unsafe(w):
                fresh.append(i)
        words = [chunks[i] for i in fresh]
        learned = self._learn(words)
        for i, x in zip(fresh, learned):
            ids[i] = x
        self.young.update((w, x) for w, x in zip(words, learned) if len(w) <= 64)
        return ids

    def _distinct(self, chunks: pa.Array) -> tuple[pa.LargeListArray, np.ndarray]:
        """(ids of " " + each of different chunks, unsafe).

        A chunk of a word and one closing mark is its word's ids and the
        mark's, as letters and marks are never in one pre-token.
        """
        marked, mark = _marked(chunks)
        bare = pc.if_else(pa.array(marked), pc.utf8_rtrim(chunks, MARKS), chunks).dictionary_encode()
        known = self._known(bare.dictionary.to_pylist())
        at = bare.indices.to_numpy()
        size = np.fromiter((len(x) // 4 if x else 0 for x in known), dtype=np.int64, count=len(known))
        unsafe = np.fromiter((x is None for x in known), dtype=bool, count=len(known))
        own = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(size))), pa.array(np.frombuffer(b"".join(filter(None, known)), dtype="<u4")))
        own = own.take(bare.indices)
        bounds = np.append(0, np.cumsum(size[at] + marked))
        ids = np.empty(int(bounds[-1]), dtype=np.uint32)
        last = bounds[1:][marked] - 1
        rest = np.ones(len(ids), dtype=bool)
        rest[last] = False
        ids[rest], ids[last] = own.values.to_numpy(), self.marks[mark[marked]]
        return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids)), unsafe[at]

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; each different chunk of the texts is looked up once."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy()
        flat, first = split.values.slice(first[0], first[-1] - first[0]), first - first[0]
        behind = np.ones(len(flat), dtype=bool)
        behind[first[:-1]] = False
        heads = flat.take(pa.array(first[:-1])).to_pylist()
        chunks = flat.filter(pa.array(behind)).dictionary_encode()
        first = first - np.arange(len(first))                                     # without heads
        ids, unsafe = self._distinct(chunks.dictionary)
        ids = ids.take(chunks.indices)                                            # every chunk's, in the order of the texts
        at = 4 * ids.offsets.to_numpy()[first]
        data = memoryview(ids.values.to_numpy()).cast("B")
        bad = np.append(0, np.cumsum(unsafe[chunks.indices.to_numpy()]))[first]
        alone = (bad[1:] > bad[:-1]) | np.fromiter(map(_unsafe, heads), dtype=bool, count=len(heads))
        encoded = [b""] * len(heads)
        whole = np.flatnonzero(alone).tolist()
        for i, x in zip(whole, self._encode(texts.take(pa.array(whole, pa.int64())).to_pylist())):
            encoded[i] = x
        begun = np.flatnonzero(~alone).tolist()
        for i, x in zip(begun, self._encode([heads[i] for i in begun])):
            encoded[i] = b"".join((x, data[at[i]:at[i + 1]]))
        return encoded


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


class Packer:
    """Packs item sizes online; pieces are (item, start, length), a window a list of them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)      # open windows at each fill level
        self.open: dict[int, list[list[tuple[int, int, int]]]] = {}

    def place(self, item, start: int, size: int) -> list[tuple[int, int, int]] | None:
        """Put size < capacity tokens where the sum of squared counts ends up least; the window, if that fills it."""
        n, cap = self.count, self.capacity
        # from level h to h + size: squares change by 2 * (n[h + size] - n[h]) + 2; to the full level by 1 - 2 * n[h];
        # a new window: 2 * n[size] + 1
        best, at = 2 * int(n[size]) + 1, 0
        if size < cap:
            cost = np.where(n[1:cap - size] > 0, 2 * (n[1 + size:cap] - n[1:cap - size]) + 2, np.iinfo(np.int64).max)
            if len(cost):
                k = int(cost.argmin())
                if cost[k] < best:
                    best, at = int(cost[k]), k + 1
            if n[cap - size] and 1 - 2 * int(n[cap - size]) <= best:
                at = cap - size
        window = []
        if at:
            window = self.open[at].pop()
            n[at] -= 1
        window.append((item, start, size))
        level = at + size
        if level == cap:
            return window
        self.open.setdefault(level, []).append(window)
        n[level] += 1
        return None

    def finish(self) -> Iterator[list[tuple[int, int, int]]]:
        """The open windows, refilled by cutting to full ones; what is left over in windows of powers of two."""
        stack = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        pieces = [p for w in stack for p in w]
        left = sum(p[2] for p in pieces)
        window, room = [], 0
        for item, start, size in pieces:
            while size:
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                take = min(size, room)
                window.append((item, start, take))
                start, size, room, left = start + take, size - take, room - take, left - take
                if not room:
                    yield window
                    window = []
        self.open.clear()
        self.count[:] = 0


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = END_ID) -> DataFrame:
    """One row for each piece; sequences are full, or of a power of two at a partition's end, so none needs padding."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = tokenizer(path)
        packer = Packer(capacity)
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}                      # item: doc_id, total, first token kept, its ids
        item = 0
        rows: list[list] = [[] for _ in range(7)]

        def close(window):
            nonlocal sequence
            at = 0
            for i, start, size in window:
                doc, total, base, ids = held[i]
                cut = ids[4 * (start - base):4 * (start - base + size)]
                for col, v in zip(rows, (doc, start, size, zlib.crc32(cut), total, sequence, at)):
                    col.append(v)
                at += size
            sequence += 1

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            for c in rows:
                c.clear()
            return out

        for piece in T.slices(batches, size=PIECE):
            ids_of = piece.column(0).to_pylist()
            for doc, ids in zip(ids_of, encode(piece.column(1))):
                ids += end
                total = len(ids) // 4
                full = total - total % capacity
                for start in range(0, full, capacity):
                    held[item] = (doc, total, 0, ids)
                    close([(item, start, capacity)])
                held.pop(item, None)
                if total > full:
                    held[item] = (doc, total, full, ids[4 * full:])
                    if (window := packer.place(item, full, total - full)) is not None:
                        close(window)
                        for i, _, _ in window:
                            del held[i]
                item += 1
            if len(rows[0]) >= 10_000:
                yield batch()
        for window in packer.finish():
            close(window)
        yield batch()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
