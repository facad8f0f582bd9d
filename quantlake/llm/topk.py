"""Exact top-k inner products, score at a time over impact-ordered posting segments.

Vectors are quantised to integers.  A block of vectors is indexed by dimension: a
posting is (vector, impact), the impact being how far the component lies from the
dimension's middle value in the block, which adds the same to all scores.  A
dimension's postings are sorted by falling size of impact and cut into segments of
equal quantised impact, LEVELS of them.  A query works the segments of all dimensions off by falling
product of its weight and the segment's greatest impact, adding to one accumulator
a vector.  After each round the segments not yet seen bound what any score can still
gain or lose; the query stops when that proves that no vector but a few can enter
its k best, and these possible members are rescored exactly from their components.

Rows that repeat both id and vector are folded first; the others are dealt out
by a hash of both.  A task keeps the index of one block and queries stream past it, so
vectors are copied once for every BLOCK_QUERIES queries and queries once for every block;
a query's k best different ids in a block go on to the merge.

Defined results: vectors that are null or empty, of another length than the query's, or hold null
or non-finite components take no part; a query never returns its own
vec_id, so neither its repeated rows; ties go to the smaller vec_id;
a repeated vec_id counts once (its rows rank by score, the best stays); fewer
than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantlake.session import materialize

#: Vectors and bytes of a block at most on average, and queries that stream past one block in one task.
BLOCK_VECTORS, BLOCK_BYTES = 8_192, 1 << 25
BLOCK_QUERIES = 65_536
#: Quantised impacts of a dimension, and rounds after which a query looks for its proof.
LEVELS, ROUNDS = 8, 8
#: A query rescores once this share of a block can still be among its best; that costs less than the postings left.
FEW = 1 / 32
#: Partitions of blocks at most; beyond it a task works off several blocks, one after the other.
MAX_PARTS = 1 << 14


class ImpactIndex:
    """Posting segments of one block: int64 matrix (vectors x dimensions)."""

    def __init__(self, vectors: np.ndarray):
        self.exact = vectors                                  # members are rescored in integers
        n, dims = vectors.shape
        v = vectors.astype(np.float64)
        middle = np.floor(np.median(v, axis=0)) if n else np.zeros(dims)
        v -= middle
        order = np.argsort(-np.abs(v), axis=0, kind="stable")
        #: Postings of each dimension by falling impact.
        self.vector, self.impact = order.T.copy(), np.take_along_axis(v, order, axis=0).T.copy()
        size = np.abs(self.impact)
        #: A component's greatest size with the middle value taken off it: what rounding is measured by.
        self.most = (np.abs(vectors.astype(np.float64)).max(axis=0) if n else np.zeros(dims)) + np.abs(middle)
        self.rounding = (dims + ROUNDS + 8) * 2.0 ** -51
        cuts = []
        for d in range(dims if n else 0):
            top = size[d, 0]
            if top > 0:
                level = np.ceil(size[d] / top * LEVELS)       # LEVELS..0, falling; impacts of 0 have no posting
                at = np.flatnonzero(np.diff(level, prepend=np.inf))
                end = np.append(at[1:], n)
                cuts += [(d, i, j) for i, j in zip(at, end) if size[d, i] > 0]
        self.dim, self.begin, self.end = np.array(cuts, dtype=np.int64).reshape(-1, 3).T
        self.edge = size[self.dim, self.begin]                # greatest impact of each segment

    def rounds(self, query: np.ndarray):
        """(segments, slack): a query's segments by falling weight x impact in rounds of about as many postings each, and
        how far a score may lie from its accumulator after the round."""
        size = np.abs(query)
        worth = size[self.dim] * self.edge
        order = np.argsort(-worth, kind="stable")
        order = order[worth[order] > 0]
        rounding = (size @ self.most) * self.rounding
        seen = np.cumsum((self.end - self.begin)[order])
        stops = np.unique(np.searchsorted(seen, np.arange(1, ROUNDS + 1) * (seen[-1] / ROUNDS)) + 1).clip(max=len(order)) if len(order) else [0]
        at = 0
        for stop in stops:
            rest = np.zeros(len(query))
            np.maximum.at(rest, self.dim[order[stop:]], worth[order[stop:]])     # the next segment of each dimension
            yield order[at:stop], rest.sum() * (1 + self.rounding) + rounding
            at = stop

    def add(self, score: np.ndarray, query: np.ndarray, segments: np.ndarray) -> None:
        """Add the postings of some segments to the accumulators."""
        if len(segments):
            spans = [(self.dim[i], slice(self.begin[i], self.end[i])) for i in segments]
            weight = np.repeat(query[self.dim[segments]], (self.end - self.begin)[segments])
            weight *= np.concatenate([self.impact[s] for s in spans])
            score += np.bincount(np.concatenate([self.vector[s] for s in spans]), weights=weight, minlength=len(score))

    def scores(self, members: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products, 64-bit integers where they surely fit, else Python's."""
        if np.abs(query.astype(np.float64)) @ self.most < 2.0 ** 62:         # most is no less than any component
            return self.exact[members] @ query
        return np.array([sum(map(int.__mul__, row, query.tolist())) for row in self.exact[members].tolist()], dtype=object)

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
        """(query row, vector row, score) of each query's k best ids by (score, smaller id), its own id left out.

        An id of several rows counts once, by its best.
        """
        by_id = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], ids[by_id][1:] != ids[by_id][:-1]])) if len(ids) else np.zeros(0, np.int64)
        few = max(8 * k, int(FEW * len(ids)))
        out = []
        for r, q in enumerate(queries.astype(np.float64)):
            score = np.zeros(len(ids))
            others = ids != own[r]
            members = np.zeros(0, np.int64)
            for segments, slack in self.rounds(q):
                self.add(score, q, segments)
                acc = np.where(others, score, -np.inf)
                top = np.maximum.reduceat(acc[by_id], starts) if len(starts) < len(acc) else acc   # one value an id
                n = int(np.isfinite(top).sum())
                if not n:
                    break
                kth = np.partition(top, len(top) - min(k, n))[len(top) - min(k, n)]
                members = np.flatnonzero((acc >= kth - 2 * slack) & others)        # all others are proven to be out
                if len(members) <= few:
                    break
            if len(members):
                found = self.scores(members, queries[r])
                best = np.array(sorted(range(len(members)), key=lambda i: (-int(found[i]), int(ids[members[i]]))), dtype=np.int64) if found.dtype == object \
                    else np.lexsort((ids[members], -found))
                first = np.unique(ids[members[best]], return_index=True)[1]
                best = best[np.sort(first)[:k]]
                out.append((np.full(len(best), r), members[best], found[best]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


def _by_width(parts: list[tuple[np.ndarray, list[bytes]]]):
    """(width, ids, matrix) of the rows of each vector length."""
    ids = np.concatenate([i for i, _ in parts]) if parts else np.zeros(0, np.int64)
    rows = [row for _, part in parts for row in part]
    widths = np.array([len(row) for row in rows], dtype=np.int64)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        yield width, ids[own], np.frombuffer(b"".join(rows[i] for i in own), dtype="<i8").reshape(len(own), -1)


def quantised(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """id, q: floor(scale * x) of every component; rows with a null or non-finite component are left out."""
    x = F.transform(column, lambda v: F.floor(F.lit(scale).cast("double") * v.cast("double")).cast("long"))
    fine = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), x.alias("q")))


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score for every row for which is_query(column id) holds, against all other rows.

    Scores are exact integers; one that does not fit into 64 bits fails the query.
    """
    def packed(batches):
        for b in batches:
            q = b.column(1)
            rows = [np.array(x, dtype="<i8").tobytes() for x in q.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["id", "q"])

    base = materialize(quantised(vectors, id_col, column, scale).mapInArrow(packed, "id long, q binary").distinct(), "vectors")
    counts = base.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query(F.col("id")), 1)).alias("m"), F.sum(F.length("q")).alias("size")).first()
    n_blocks = max(-(-counts["n"] // BLOCK_VECTORS), -(-(counts["size"] or 0) // BLOCK_BYTES)) or 1
    n_query_blocks = -(-counts["m"] // BLOCK_QUERIES) or 1

    def block(n: int):
        return F.pmod(F.xxhash64("id", "q"), F.lit(n)).cast("int")

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = base.withColumn("vb", block(n_blocks)).withColumn("qb", each(n_query_blocks)).withColumn("asks", F.lit(0))
    queries = (base.where(is_query(F.col("id"))).withColumn("qb", block(n_query_blocks)).withColumn("vb", each(n_blocks))
               .withColumn("asks", F.lit(1)))
    columns = ["vb", "qb", "asks", "id", "q"]

    def meet(batches):
        """A block's vectors come before the queries that it answers; vectors of one length meet each other."""
        at, vectors, index = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(i)) for i in range(3)], axis=1)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(keys)]):
                if i == j:
                    continue
                if at != tuple(keys[i, :2]):
                    at, vectors, index = tuple(keys[i, :2]), [], None
                part = (np.asarray(batch.column(3))[i:j], batch.column(4).slice(i, j - i).to_pylist())
                if not keys[i, 2]:
                    vectors.append(part)
                    continue
                if index is None:
                    index = {}
                    for width, ids, matrix in _by_width(vectors):
                        index[width] = (ids, ImpactIndex(matrix))
                    vectors = []
                for width, own, matrix in _by_width([part]):
                    if width in index:
                        ids, block_index = index[width]
                        r, c, found = block_index.search(matrix, own, ids, k)
                        yield pa.RecordBatch.from_arrays([pa.array(own[r], pa.int64()), pa.array(ids[c], pa.int64()), pa.array(found, pa.int64())],
                                                         names=["query_id", "vec_id", "score"])

    near = (candidates.select(*columns).union(queries.select(*columns)).repartition(min(4 * n_blocks * n_query_blocks, MAX_PARTS), "vb", "qb")
            .sortWithinPartitions("vb", "qb", "asks").mapInArrow(meet, "query_id long, vec_id long, score long"))
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
