"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are split by the vocabulary's pattern.  Inside one, adjacent pairs
wait in one bucket for each merge rank; a two-level bitmap tells the lowest
rank with find-first-set, a linked list over the byte positions gives the
neighbours, and entries that a merge has outdated are skipped when they come
up.  Work is O(n log n) in the length of a pre-token, so very long ones cost
no more for each byte than short ones.

Defined results: a null or empty text has no ids and decodes to nothing.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

#: Pre-tokens whose ids a worker keeps; it starts anew beyond (speed only).
CACHE_ENTRIES = 700_000


#: A pattern in the syntax of the regex module, and one for the re module that gives the same on plain characters.
FAST_FOR = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FAST = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
#: Pre-tokens of more characters go through the queue one by one.
LONG = 256


class _CharTest:
    """True for texts whose characters are all of categories on which both patterns agree."""

    AGREED = frozenset(("Lu", "Ll", "Lt", "Lo", "Lm", "Nd", "Po", "Ps", "Pe", "Pd", "Pi", "Pf", "Pc", "Sm", "Sc", "Sk", "So"))

    def __init__(self):
        self.known: dict[str, bool] = {c: True for c in " \n\t\r"}

    def __call__(self, text: str) -> bool:
        known = self.known
        for c in set(text):
            ok = known.get(c)
            if ok is None:
                ok = known[c] = unicodedata.category(c) in self.AGREED
            if not ok:
                return False
        return True


class BPE:
    """ranks: token bytes to rank, the rank being the id; every single byte is a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        size = np.array([len(x) for x in self.bytes_of], dtype=np.int64)
        self.size = size
        self.begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.table = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.cache: dict[str, bytes] = {}
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        made = sorted((ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self.pairs = np.array([x[0] for x in made], dtype=np.int64)
        self.pair_ranks = np.array([x[1] for x in made], dtype=np.int64)
        self.fast = re.compile(FAST).findall if pattern == FAST_FOR else None
        self.checked = _CharTest() if self.fast else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: always the lowest rank, and of equal ones the leftmost pair, merges next."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        part = [word[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        wanted = [-1] * n                       # the rank a position waits for; an entry that differs is stale
        buckets: dict[int, list[int]] = {}
        leaves: dict[int, int] = {}             # 64 ranks each
        summary = 0                             # which leaves have a bit
        for i in range(n - 1):
            r = ranks.get(word[i:i + 2])
            if r is not None:
                wanted[i] = r
                if r in buckets:
                    buckets[r].append(i)        # ascending, so a heap already
                else:
                    buckets[r] = [i]
                    leaves[r >> 6] = leaves.get(r >> 6, 0) | 1 << (r & 63)
                    summary |= 1 << (r >> 6)
        while summary:
            leaf = (summary & -summary).bit_length() - 1
            bits = leaves[leaf]
            rank = leaf << 6 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heapq.heappop(bucket)
            if not bucket:
                del buckets[rank]
                bits &= bits - 1
                leaves[leaf] = bits
                if not bits:
                    summary &= summary - 1
            if wanted[i] != rank:
                continue
            j = after[i]
            part[i] += part[j]
            wanted[j] = -1
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a < 0 or b >= n:
                    if a >= 0:
                        wanted[a] = -1
                    continue
                r = ranks.get(part[a] + part[b])
                wanted[a] = -1 if r is None else r
                if r is not None:
                    if r in buckets:
                        heapq.heappush(buckets[r], a)
                    else:
                        buckets[r] = [a]
                        leaves[r >> 6] = leaves.get(r >> 6, 0) | 1 << (r & 63)
                        summary |= 1 << (r >> 6)
        out, i = [], 0
        while i < n:
            out.append(ranks[part[i]])
            i = after[i]
        return out

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """As ``merge`` for many short pre-tokens at once: one linked list and one queue hold them all.

        A step takes the lowest rank and merges its leftmost live pair in
        every pre-token that has one; further pairs of the rank wait, as a
        merge may have made a lower rank.
        """
        length = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(length)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(raw)
        token = self.single[raw].astype(np.int64)
        word = np.repeat(np.arange(len(words)), length)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - length] = -1
        wanted = np.full(n, -1, dtype=np.int64)
        i = np.flatnonzero(after >= 0)
        wanted[i] = self.rank_of(token[i], token[i + 1])
        i = i[wanted[i] >= 0]
        i = i[np.argsort(wanted[i], kind="stable")]
        r, cut = np.unique(wanted[i], return_index=True)
        buckets = {int(k): x.tolist() for k, x in zip(r, np.split(i, cut[1:]))}
        leaves: dict[int, int] = {}
        summary = 0
        for k in buckets:
            leaves[k >> 6] = leaves.get(k >> 6, 0) | 1 << (k & 63)
            summary |= 1 << (k >> 6)
        while summary:
            leaf = (summary & -summary).bit_length() - 1
            bits = leaves[leaf]
            rank = leaf << 6 | (bits & -bits).bit_length() - 1
            i = np.unique(np.array(buckets[rank]))
            i = i[wanted[i] == rank]
            w = word[i]
            first = np.ones(len(i), dtype=bool)
            np.not_equal(w[1:], w[:-1], out=first[1:])
            if first.all():
                del buckets[rank]
                leaves[leaf] = bits & (bits - 1)
                if not leaves[leaf]:
                    summary &= summary - 1
            else:
                buckets[rank] = i[~first].tolist()
                i = i[first]
            if not len(i):
                continue
            j = after[i]
            k = after[j]
            token[i] = rank
            token[j] = -1
            wanted[j] = -1
            after[i] = k
            has = k >= 0
            wanted[i] = -1
            a, c = i[has], k[has]
            before[c] = a
            h = before[i]
            h = h[h >= 0]
            left = np.concatenate([h, a])
            new = self.rank_of(token[left], token[np.concatenate([after[h], c])])
            wanted[left] = new
            for x, y in zip(new.tolist(), left.tolist()):
                if x < 0:
                    continue
                if x in buckets:
                    buckets[x].append(y)
                else:
                    buckets[x] = [y]
                    leaves[x >> 6] = leaves.get(x >> 6, 0) | 1 << (x & 63)
                    summary |= 1 << (x >> 6)
        alive = token >= 0
        count = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] * 4
        packed = token[alive].astype("<u4").tobytes()
        count = count.tolist()
        return [packed[x:y] for x, y in zip(count, count[1:])]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that the pair makes, or -1."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def learn(self, words: set[str]) -> None:
        """Encode pre-tokens and keep their ids; long ones are left to encode()."""
        if len(self.cache) + len(words) > CACHE_ENTRIES:
            self.cache.clear()
        short = [w for w in words if len(w) <= LONG]
        raw = [w.encode() for w in short]
        whole = [self.ranks.get(w) for w in raw]
        for w, i in zip(short, whole):
            if i is not None:
                self.cache[w] = i.to_bytes(4, "little")
        rest = [k for k, i in enumerate(whole) if i is None]
        if rest:
            for k, ids in zip(rest, self.merge_all([raw[k] for k in rest])):
                self.cache[short[k]] = ids

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        known = self.cache.get
        split = [self.words(t) for t in texts]
        parts = [list(map(known, words)) for words in split]
        missing = {w for words, part in zip(split, parts) if None in part for w, x in zip(words, part) if x is None}
        if missing:
            self.learn(missing)
            for words, part in zip(split, parts):
                if None in part:
                    part[:] = [x or known(w) or np.array(self.merge(w.encode()), dtype="<u4").tobytes()
                               for w, x in zip(words, part)]
        return [b"".join(part) for part in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def words(self, text: str) -> list[str]:
        """Pre-tokens; a text of plain characters only is split by an equal pattern that runs faster."""
        return self.fast(text) if self.fast and self.checked(text) else self.split(text)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4")
        size = self.size[ids]
        shift = self.begin[ids] - (np.cumsum(size) - size)
        return self.table[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> BPE:
    """The vocabulary, once for each worker; its file lies on every machine."""
    return BPE(read_ranks(path), pattern)


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, decoded from the ids."""
    def run(batches):
        bpe = load(path, pattern)
        for piece in T.slices(batches, size=8 << 20):
            n, ids, back = [], [], []
            for packed in bpe.encode_batch([t or "" for t in piece.column(1).to_pylist()]):
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(bpe.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def encode_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the ids of every whole text as an array."""
    def run(batches):
        bpe = load(path, pattern)
        for piece in T.slices(batches, size=8 << 20):
            ids = [np.frombuffer(x, dtype="<u4").astype(np.int32)
                   for x in bpe.encode_batch([t or "" for t in piece.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids array<int>"))
