"""Conversation prefix trie by truncation peeling.

A conversation is a path of turns; every distinct prefix is a node.  Equal whole
paths are folded first (a hot conversation becomes one row with a count), then the
paths are dealt out by their order, so that a node's conversations are neighbours
and one hot opening spreads over many tasks.  A task peels its paths from the
greatest depth down: conversations that end at this depth join the nodes that
survived from below, all are regrouped by their path, and the last turn is
stripped; counts, leaves and savings are summed on the way, so no node is visited twice.

Only nodes on the first or last path of a task can go on in another task.  For these
a task hands on what it found on them, two rows a task, and the same peeling over
those rows finishes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.session import materialize

from . import textops as T
from .exchange import repeated

#: Conversation ids whose digits travel as one string.
CHUNK = 4096
NOBODY = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: What a path knows about one of its nodes.
_FACTS = ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")
_PATH = "k1 array<long>, k2 array<long>, lens array<long>"
_NODE = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: A path whose nodes 0..length carry facts; the boundary rows have facts at every depth, whole paths at their end alone.
_EDGE = f"edge struct<{_PATH}, " + ", ".join(f"{c} array<long>" for c in _FACTS) + ", ends array<string>>"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """(base, conv_id, turns): each conversation's turns in order as (turn, h1, h2, code points), partitioned by its hundred.

    Texts are hashed (2 x 64 bits, null as empty) before anything moves.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % 100).alias("base"), conv.alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
                 F.length(text).cast("long").alias("len")).alias("t"))
    return turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def shared_openings(arrays: DataFrame, opening: Column) -> DataFrame:
    """(conv_id, turns) with the first ``opening`` turns replaced by those of the hundred's first conversation.

    Fewer where that one has fewer, none where it is absent; the conversation's own turns
    after its first ``opening`` follow.
    """
    from pyspark.sql import Window
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 5)), ignorenulls=True).over(Window.partitionBy("base"))
    d = arrays.select("conv_id", "turns", first.alias("head"), opening.cast("int").alias("h"))
    none = F.slice("turns", 1, 0)
    return d.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none),
                                        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column without nulls."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = a.offsets.to_numpy().astype(np.int64) if len(a) else np.zeros(1, np.int64)
    return a.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def paths(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, k1, k2, lens, e1, e2, depth): at each depth the key of the prefix that ends there; e1 and e2 the whole path's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            offsets = None
            for c in ("h1", "h2"):
                h, offsets = _flat(b.column(c))
                depth = np.arange(len(h)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1
                # a prefix's key is the sum over its turns of a hash of turn and depth
                each = T.mix(h.astype(np.int64).view(np.uint64) ^ T.mix(depth.astype(np.uint64)))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
                out.append((total[1:] - np.repeat(total[offsets[:-1]], np.diff(offsets))).view(np.int64))
                out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int64())) for v in (out[0], out[2])]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *lists, b.column("lens"), pa.array(out[1]), pa.array(out[3]), pa.array(np.diff(offsets))],
                                             names=["conv_id", "k1", "k2", "lens", "e1", "e2", "depth"])

    parts = rebuilt.select("conv_id", *[F.col(f"turns.{a}").alias(b) for a, b in (("h1", "h1"), ("h2", "h2"), ("len", "lens"))])
    return parts.mapInArrow(run, f"conv_id long, {_PATH}, e1 long, e2 long, depth long")


def _ends(whole: DataFrame) -> DataFrame:
    """(first, ends): SHA-256 of the ids of all conversations with one path, under the smallest of them.

    Ids are joined in runs of at most CHUNK; a path's runs stream through one hash, so memory is that of a run.
    """
    key = ["depth", "e1", "e2"]
    runs = whole.groupBy(*key, F.floor(F.col("conv_id") / CHUNK).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    runs = runs.select(*key, "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.element_at("ids", 1).alias("first"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, sha = None, None, None
        for b in batches:
            done = ([], [])
            for d, e1, e2, f, ids in zip(*(b.column(c).to_pylist() for c in (*key, "first", "ids"))):
                if (d, e1, e2) != at:
                    if at is not None:
                        done[0].append(first)
                        done[1].append(sha.hexdigest())
                    at, first, sha = (d, e1, e2), f, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.string())], names=["first", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([sha.hexdigest()])], names=["first", "ends"])

    return runs.repartition(*key).sortWithinPartitions(*key, "run").mapInArrow(stream, "first long, ends string")


class _Peeled:
    """Nodes of some paths, found from the greatest depth down."""

    def __init__(self, offsets, k1, k2, lens, items, edges=()):
        """items: path, depth, the five facts and the number of the end's digest (-1: none), as arrays; edges: paths whose nodes others may share."""
        self.offsets, self.k, self.lens, self.edges = offsets, (k1, k2), lens, edges
        depth = np.diff(offsets)
        self.nodes = []                                     # blocks of (depth, path, facts, item, parent's conv_id)
        self.edge_facts = {r: [np.zeros(depth[r] + 1, np.int64) + (NOBODY if c == "conv_id" else 0) for c in _FACTS] for r in edges}
        self.edge_item = {r: np.full(depth[r] + 1, -1) for r in edges}
        path, at, facts, mark = items
        order = np.argsort(-at, kind="stable")
        bounds = np.searchsorted(-at[order], -np.arange(int(depth.max(initial=0)), -2, -1))
        alive = np.zeros(0, np.int64)                       # paths that speak for the nodes one deeper
        alive_facts = [np.zeros(0, np.int64)] * 5
        above = np.zeros(0, np.int64)                       # rows of self.nodes[-1] that these nodes are
        for i, d in enumerate(range(int(depth.max(initial=0)), -1, -1)):
            ended = order[bounds[i]:bounds[i + 1]]
            who = np.concatenate([path[ended], alive])
            if not len(who):
                continue
            got = [np.concatenate([facts[j][ended], alive_facts[j]]) for j in range(5)]
            got[2][len(ended):] = 1                         # each survivor is one child here
            sort, new = repeated(*self.key(who, d))
            cut = np.flatnonzero(new)
            n, first, children, leaves, saved = (np.minimum.reduceat(v[sort], cut) if j == 1 else np.add.reduceat(v[sort], cut) for j, v in enumerate(got))
            item = np.maximum.reduceat(np.concatenate([mark[ended], np.full(len(alive), -1)])[sort], cut)
            rep = who[sort[cut]]
            edge = self.on_edge(rep, d, (n, first, children, leaves, saved), item)
            if len(alive):                                  # the survivors' parent is known now
                group = np.empty(len(who), np.int64)
                group[sort] = np.cumsum(new) - 1
                up = group[len(ended):]
                self.nodes[-1][4][above] = np.where(edge[up], NOBODY, first[up])
            leaves = np.where(children == 0, 1, leaves)
            saved = saved + (n - 1) * (lens[offsets[rep] + d - 1] if d else 0)
            own = np.flatnonzero(~edge)
            self.nodes.append((d, rep[own], [v[own] for v in (n, first, children, leaves, saved)], item[own], np.full(len(own), NOBODY)))
            alive, alive_facts, above = rep[own], [n[own], first[own], children[own], leaves[own], saved[own]], np.arange(len(own))

    def key(self, path, d):
        return tuple(k[self.offsets[path] + d - 1] if d else np.zeros(len(path), np.int64) for k in self.k)

    def on_edge(self, rep, d, facts, item):
        """Which nodes lie on an edge path; what is known of them is kept there (on the first such path only)."""
        edge = np.zeros(len(rep), dtype=bool)
        for r in self.edges:
            if d > self.offsets[r + 1] - self.offsets[r]:
                continue
            mine = self.key(np.array([r]), d)
            here = np.flatnonzero((self.key(rep, d)[0] == mine[0]) & (self.key(rep, d)[1] == mine[1]) & ~edge)
            if len(here):
                for kept, v in zip(self.edge_facts[r], facts):
                    kept[d] = v[here[0]]
                self.edge_item[r][d] = item[here[0]]
                edge[here] = True
        return edge

    def table(self, ends) -> pa.RecordBatch:
        cols = [[] for _ in range(11)]
        texts = []
        for d, rep, (n, first, children, leaves, saved), item, parent in self.nodes:
            k, p = self.key(rep, d), self.key(rep, d - 1) if d else (np.zeros(len(rep), np.int64),) * 2
            for c, v in zip(cols, (np.full(len(rep), d), *k, *p, first, parent, n, children, leaves, saved)):
                c.append(v)
            texts += [EMPTY_SHA if i < 0 else ends[i] for i in item.tolist()]
        arrays = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in cols]
        parent = pa.array(arrays[6], pa.int64(), mask=arrays[6] == NOBODY)
        return pa.RecordBatch.from_arrays([*map(pa.array, arrays[:6]), parent, *map(pa.array, arrays[7:]), pa.array(texts, pa.string())],
                                          names=[c.split()[0] for c in _NODE.split(", ")])


def _peel_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel one task's whole paths: its finished nodes, and its first and last path with what was found on them."""
    t = [b for b in batches if b.num_rows]
    if not t:
        return
    t = pa.Table.from_batches(t).combine_chunks()
    (k1, offsets), (k2, _), (lens, _) = (_flat(t.column(c)) for c in ("k1", "k2", "lens"))
    rows, depth = np.arange(t.num_rows), np.diff(offsets)
    zero = np.zeros(t.num_rows, np.int64)
    facts = [t.column("n_end").to_numpy(), t.column("conv_id").to_numpy(), zero, zero, zero]
    ends = t.column("ends").to_pylist()
    low, high = _outermost(offsets, k1, k2)
    found = _Peeled(offsets, k1, k2, lens, (rows, depth, facts, rows), [low] if low == high else [low, high])
    nodes = found.table(ends)
    schema = nodes.schema
    edges = []
    for r in found.edges:
        a, b = offsets[r], offsets[r + 1]
        # a node on both edge paths is told by the first; the other says nothing of it
        item = found.edge_item[r].tolist()
        edges.append({"k1": k1[a:b].tolist(), "k2": k2[a:b].tolist(), "lens": lens[a:b].tolist(),
                      **{c: v.tolist() for c, v in zip(_FACTS, found.edge_facts[r])}, "ends": [None if i < 0 else ends[i] for i in item]})
    longs = pa.list_(pa.int64())
    edge_type = pa.struct([(c, longs) for c in ("k1", "k2", "lens", *_FACTS)] + [("ends", pa.list_(pa.string()))])
    for s in range(0, nodes.num_rows, 1 << 16):
        part = nodes.slice(s, 1 << 16)
        yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, edge_type)], names=[*schema.names, "edge"])
    yield pa.RecordBatch.from_arrays([*[pa.nulls(len(edges), f.type) for f in schema], pa.array(edges, edge_type)], names=[*schema.names, "edge"])


def _outermost(offsets, k1, k2) -> tuple[int, int]:
    """The paths that come first and last in the order of keys, shorter before longer."""
    def less(a, b):
        x, y = ((k1[offsets[r]:offsets[r + 1]], k2[offsets[r]:offsets[r + 1]]) for r in (a, b))
        m = min(len(x[0]), len(y[0]))
        at = np.flatnonzero((x[0][:m] != y[0][:m]) | (x[1][:m] != y[1][:m]))
        if not len(at):
            return len(x[0]) < len(y[0])
        return (x[0][at[0]], x[1][at[0]]) < (y[0][at[0]], y[1][at[0]])

    low = high = 0
    for r in range(1, len(offsets) - 1):
        if less(r, low):
            low = r
        elif less(high, r):
            high = r
    return low, high


def _peel_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel the tasks' edge paths, each of whose nodes brings the facts found in its task."""
    t = [b for b in batches if b.num_rows]
    if not t:
        return
    t = pa.Table.from_batches(t).combine_chunks()
    (k1, offsets), (k2, _), (lens, _) = (_flat(t.column(c)) for c in ("k1", "k2", "lens"))
    facts = [_flat(t.column(c))[0] for c in _FACTS]
    n = np.diff(offsets) + 1
    path = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    ends = t.column("ends").combine_chunks().flatten().to_pylist()
    mark = np.where([e is not None for e in ends], np.arange(len(ends)), -1)
    yield _Peeled(offsets, k1, k2, lens, (path, at, facts, mark)).table(ends)


def trie(rebuilt: DataFrame) -> DataFrame:
    """Every node of the prefix trie of (conv_id, turns) rows; see COLUMNS.

    Equal turns are equal 128-bit hashes.  The conversations' paths are written and read again, then peeled in tasks
    by their order, and at last the two edge paths of every task in one task (two rows for each of the former tasks).
    """
    whole = materialize(paths(rebuilt), "trie-paths")
    key = ["depth", "e1", "e2"]
    body = F.struct("k1", "k2", "lens")
    folded = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_end"), F.min_by(body, "conv_id").alias("b"))
    folded = folded.select("conv_id", "n_end", "b.k1", "b.k2", "b.lens").join(_ends(whole).withColumnRenamed("first", "conv_id"), "conv_id")
    dealt = folded.repartitionByRange(F.arrays_zip("k1", "k2"))
    peeled = materialize(dealt.mapInArrow(_peel_part, f"{_NODE}, {_EDGE}"), "trie-nodes")
    top = materialize(peeled.where("edge IS NOT NULL").select("edge.*").coalesce(1).mapInArrow(_peel_edges, _NODE), "trie-top")
    parents = top.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("top_id"))
    rest = peeled.where("edge IS NULL").drop("edge")
    hung = rest.where("parent_conv_id IS NULL").join(parents, ["depth", "p1", "p2"]).withColumn("parent_conv_id", F.col("top_id"))
    return (rest.where("parent_conv_id IS NOT NULL").select(*COLUMNS).unionByName(hung.select(*COLUMNS)).unionByName(top.select(*COLUMNS)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each opened with crc32(conv_id) mod 6 turns of its hundred's first one.

    Turns are ordered by turn (null first; equal turn numbers by their hash); a null role or text is empty; rows without
    a conv_id belong to no conversation.  A repeated row is a turn of its own.  A conversation without turns after
    rebuilding ends at the root.  An empty table has no nodes.  Columns other than conv_id, turn, role and text are not
    read.  One conversation's path (24 bytes a turn) must fit into a row.
    """
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return trie(shared_openings(turn_arrays(conversations), opening))
