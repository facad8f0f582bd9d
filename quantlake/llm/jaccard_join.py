"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Every document is a set of hashed word n-grams in one global order, rare ones
first (frequencies come from a count over all texts in a fixed number of
buckets; any order is right, this one keeps lists short).  Documents with
equal sets are one class from then on.

Candidates share an n-gram of both prefixes at places that leave room for
enough overlap.  A pair's overlap is then counted by vertical partitioning:
the order is cut into FRAGMENTS, every fragment counts its own part of the
overlaps of its group of pairs, and the parts are summed for each pair.

A group of near copies is never expanded into all its pairs: the first round
verifies, for each shared n-gram, the pairs of its smallest document with the
others, and components follow; the second verifies every candidate pair
whose documents are in different components still.  Before either, pairs
whose parity sketches differ in more bits than linked sets can are proven to be no links, so whole
sets travel only for pairs that nearly always are.  No link that would join
two components is left out.

Links are counted inside the finished components, where all of them are: a
component's different sets are dealt out in blocks, every pair of blocks is one
unit of work, and a unit counts all overlaps of its sets by matrix products.

Defined results: null or wordless texts have an empty set and are linked
with nothing and have no links; rows that repeat a doc_id count as one document, by the text
with the least set hash, and get one component; a null doc_id has a null
component unless it is linked; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.session import materialize

from . import exchange as X
from . import textops as T
from .components import components
from .substring_dedup import _in_groups

#: Frequency buckets (as a power of two) that give the order, fragments that it is cut into, bits of a parity sketch.
ORDER_BITS, FRAGMENTS, SKETCH_BITS = 18, 8, 1024
#: Pairs, and n-grams of their sets, for which one group of pairs to verify is planned; n-grams that are sent or looked up at once.
HUB_PAIRS, GROUP_GRAMS, HELD_GRAMS = 4096, 1 << 22, 1 << 18
#: Sets, and n-grams of sets, that a block of one component is planned for; n-grams that one matrix product takes.
BLOCK_SETS, BLOCK_GRAMS, PRODUCT_GRAMS = 2048, 1 << 20, 1024
#: Lists up to this length drop entries without any possible partner before they are kept.
SHORT_LIST = 512

_ENTRY = {"h": "<u8", "node": "<i8", "n": "<i4", "pos": "<i4"}
_FULL = {**_ENTRY, "comp": "<i8", "s0": "<u8", "s1": "<u8", "s2": "<u8", "s3": "<u8"}
_PAIR = {"a": "<i8", "b": "<i8", "na": "<i4", "nb": "<i4"}
_COUNT = {**_PAIR, "c": "<i4"}


def _grams(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every n-gram, repeats included; a text of fewer words is one n-gram."""
    buf, bounds = T.joined(texts)
    buf = T.LOWER[buf]
    starts, ends = T.word_spans(buf)
    first = T.per_text(starts, bounds)
    h = T.word_hashes(buf, starts, ends)
    at, grams = T.windows(h, first, k)
    n = np.diff(first)
    few = np.flatnonzero((n > 0) & (n < k))
    text = np.concatenate([T.doc_of(first)[at] if len(at) else at, few])
    short = T.span_hashes(h, first[few], first[few] + n[few]) if len(few) else np.zeros(0, np.uint64)
    return text, np.concatenate([grams, short])


def _sketches(first: np.ndarray, h: np.ndarray) -> list[bytes]:
    """Parity sketch of every set: a bit is the parity of the n-grams hashed to it, so two sketches differ in no more bits than their sets."""
    bit = (T.mix(h) >> T.U(54)).astype(np.int64)
    out = []
    for lo in range(0, len(first) - 1, 1024):
        hi = min(lo + 1024, len(first) - 1)
        a, b = first[lo], first[hi]
        row = np.repeat(np.arange(hi - lo), np.diff(first[lo:hi + 1]))
        odd = np.bincount(row * SKETCH_BITS + bit[a:b], minlength=(hi - lo) * SKETCH_BITS).reshape(-1, SKETCH_BITS) & 1
        out += [x.tobytes() for x in np.packbits(odd.astype(np.uint8), axis=1)]
    return out


def _words(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), "<u8").reshape(-1, SKETCH_BITS // 64)


def _near(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sketches differ in no more bits than two linked sets can differ in n-grams."""
    apart = np.bitwise_count(a ^ b).sum(axis=1).astype(np.int64)
    return apart * (num + den) <= (den - num) * (na.astype(np.int64) + nb)


def _close(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that their sketches don't disprove, written to the shared folder; sketches: (node, sketch)."""
    def look(batches):
        for t in batches:
            a, b, na, nb = (t.column(k).to_numpy() for k in range(4))
            if len(a):
                k = np.flatnonzero(_near(_words(t.column(4).to_pylist()), _words(t.column(5).to_pylist()), na, nb, num, den))
                yield pa.RecordBatch.from_arrays([pa.array(v[k]) for v in (a, b, na, nb)], names=list(_PAIR))

    both = (pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")).hint("merge"), "a")
            .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")).hint("merge"), "b"))
    return materialize(both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(look, "a long, b long, na int, nb int"), "close-pairs")


def _sets(texts: pa.Array, k: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hash): the distinct n-grams of text i are hash[bounds[i]:bounds[i + 1]], in the global order."""
    text, h = _grams(texts, k)
    order = np.lexsort((h, rank[(h >> T.U(64 - ORDER_BITS)).astype(np.int64)], text))
    text, h = text[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    text, h = text[new], h[new]
    return np.searchsorted(text, np.arange(len(texts) + 1)), h


def _set_hashes(first: np.ndarray, h: np.ndarray) -> list[pa.Array]:
    """Two hashes of every set, whatever the order of its n-grams."""
    total = [np.concatenate([[T.U(0)], np.cumsum(T.mix(h ^ T.U(s)))]) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return [pa.array((t[first[1:]] - t[first[:-1]]).view(np.int64)) for t in total]


def judged_rows(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row of every doc_id, all columns kept: the one by whose text near_duplicates judges the id (ties: the least text, then the least row)."""
    any_order = np.zeros(1 << ORDER_BITS, dtype=np.uint8)

    def hashed(batches):
        for piece in T.slices(batches):
            first, h = _sets(piece.column(1), k, any_order)
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(n == 0), *_set_hashes(first, h), pa.array(n)],
                                             names=["row", "text", "empty", "s", "s2", "n"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, empty boolean, s long, s2 long, n long"
    rank = F.struct("empty", "s", "s2", "n", "text", F.to_json("row"))
    return rows.mapInArrow(hashed, schema).groupBy("row.doc_id").agg(F.min_by("row", rank).alias("row")).select("row.*")


def gram_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Occurrences of all n-grams of all texts in 2**ORDER_BITS hash buckets (2 MB at any corpus size)."""
    size, chunk = 1 << ORDER_BITS, 1 << 14

    def add(batches):
        total = np.zeros(size, dtype=np.int64)
        for piece in T.slices(batches):
            _, h = _grams(piece.column(0), k)
            total += np.bincount((h >> T.U(64 - ORDER_BITS)).astype(np.int64), minlength=size)
        at = [c for c in range(0, size, chunk) if total[c:c + chunk].any()]
        yield pa.RecordBatch.from_arrays([pa.array([c // chunk for c in at], pa.int32()),
                                          pa.array([total[c:c + chunk].astype("<u4").tobytes() for c in at], pa.binary())], names=["part", "n"])

    def together(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("n").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    out = np.zeros(size, dtype=np.int64)
    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(add, "part int, n binary")
            .groupBy("part").applyInArrow(together, "part int, n binary").collect())
    for r in rows:
        out[r["part"] * chunk:(r["part"] + 1) * chunk] = np.frombuffer(r["n"], "<i8")
    return out


def _ranks(counts: np.ndarray) -> np.ndarray:
    """An eighth of an octave of frequency a step; 0 to 255."""
    return np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8)


def _pivots(counts: np.ndarray, rank: np.ndarray, fragments: int) -> np.ndarray:
    """Cuts of the order (rank << 56 | hash >> 8) into fragments of about equal numbers of n-grams."""
    mass = np.bincount(rank, weights=counts, minlength=256)
    ends = np.cumsum(mass)
    out = []
    for f in range(1, fragments):
        want = ends[-1] * f / fragments
        r = int(np.searchsorted(ends, want))
        inside = (want - (ends[r] - mass[r])) / max(mass[r], 1)
        out.append(T.U(r) << T.U(56) | T.U(int(inside * ((1 << 56) - 1))))
    return np.array(out, dtype=np.uint64)


def _may_link(na, i, nb, j, num: int, den: int):
    """Whether sets of na and nb n-grams whose first shared one is at i and j can overlap enough."""
    na, nb = na.astype(np.int64), nb.astype(np.int64)
    room = np.minimum(na - i, nb - j)
    return (room * (num + den) >= num * (na + nb)) & (np.minimum(na, nb) * den >= num * np.maximum(na, nb))


def _groups(h: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return list(zip(cut.tolist(), [*cut[1:].tolist(), len(h)]))


def _verify(pairs: DataFrame, sets: DataFrame, rank: np.ndarray, pivots: np.ndarray, num: int, den: int) -> DataFrame:
    """a, b of the pairs (a, b, na, nb) whose sets (node, tokens) have a Jaccard similarity of num / den or more."""
    total, grams = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("na").cast("long") + F.col("nb")), F.lit(0))).first()
    groups, sums = max(16, -(-total // HUB_PAIRS), -(-grams // GROUP_GRAMS)), max(16, -(-total // 50_000))
    fragments = len(pivots) + 1
    per_hub = pairs.groupBy("a").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(HUB_PAIRS)), F.ceil(F.sum("nb") / F.lit(GROUP_GRAMS))).alias("s"))
    placed = pairs.join(per_hub, "a").select("a", "b", "na", "nb", F.pmod(
        F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("s"))), F.lit(groups)).cast("int").alias("g"))
    need = (placed.select(F.col("a").alias("node"), "g").union(placed.select(F.col("b").alias("node"), "g")).distinct()
            .groupBy("node").agg(F.collect_list("g").alias("gs")))

    def cut(batches):
        """A row for each set, group and fragment: a set is in the global order, so its part of a fragment is one slice."""
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(nodes, pa.int64()), pa.array(tokens, pa.binary())], names=["part", "node", "h"])

        parts, nodes, tokens, held = [], [], [], 0
        for b in batches:
            for node, packed, gs in zip(*(b.column(k).to_pylist() for k in range(3))):
                h = np.frombuffer(packed, "<u8")
                place = rank[(h >> T.U(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64) << T.U(56) | h >> T.U(8)
                edges = [0, *np.searchsorted(place, pivots).tolist(), len(h)]
                own = [(f, packed[8 * lo:8 * hi]) for f, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi]
                for g in gs:
                    for f, x in own:
                        parts.append(g * fragments + f)
                        nodes.append(node)
                        tokens.append(x)
                    held += len(h)
                    if held >= HELD_GRAMS:
                        yield rows()
                        parts, nodes, tokens, held = [], [], [], 0
        if parts:
            yield rows()

    def spread(batches):
        for b in batches:
            a, c, na, nb, g = (x.to_numpy() for x in b.columns)
            part = (g[:, None].astype(np.int64) * fragments + np.arange(fragments)).ravel()
            yield X.rows("part", part, _PAIR, [np.repeat(v, fragments) for v in (a, c, na, nb)])

    def overlaps(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, na, nb = X.entries(right, _PAIR)
        if not len(a):
            return X.tables([], "part", _COUNT)
        packed = left.column("h").to_pylist()
        node, h = np.repeat(left.column("node").to_numpy(), [len(x) // 8 for x in packed]), np.frombuffer(b"".join(packed), "<u8")
        ids, node = np.unique(node, return_inverse=True)
        token = np.unique(h, return_inverse=True)[1] if len(h) else h.astype(np.int64)
        keys = np.sort(node.astype(np.int64) << 32 | token)
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
        first = np.searchsorted(keys, np.arange(len(ids) + 1, dtype=np.int64) << 32)
        ia, ib = (np.minimum(np.searchsorted(ids, v), max(len(ids) - 1, 0)) for v in (a, b))
        count = np.zeros(len(a), dtype=np.int32)
        if len(ids):
            here = (ids[ia] == a) & (ids[ib] == b)
            n = np.where(here, first[ia + 1] - first[ia], 0)
            lo = 0
            ends = np.cumsum(n)
            while lo < len(a):                            # pairs in pieces of about HELD_GRAMS
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + HELD_GRAMS, side="right")))
                m = n[lo:hi]
                own = np.repeat(np.arange(lo, hi), m)
                step = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
                wanted = (keys[first[ia[own]] + step] & 0xFFFFFFFF) | ib[own].astype(np.int64) << 32
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                count[lo:hi] = np.bincount(own - lo, weights=keys[at] == wanted, minlength=hi - lo)
                lo = hi
        some = np.flatnonzero(count)
        part = X.buckets_of(a ^ (b * 31), sums)
        return X.tables([X.rows("part", part[some], _COUNT, [v[some] for v in (a, b, na, nb, count)])], "part", _COUNT)

    def together(key: tuple, table: pa.Table) -> pa.Table:
        a, b, na, nb, c = X.entries(table, _COUNT)
        order, new = X.repeated(a, b)
        first = order[new]
        both = np.add.reduceat(c[order].astype(np.int64), np.flatnonzero(new)) if len(order) else c.astype(np.int64)
        a, b = a[first], b[first]
        union = na[first].astype(np.int64) + nb[first] - both
        yes = both * den >= num * union
        return pa.table({"a": pa.array(a[yes]), "b": pa.array(b[yes])})

    tokens = sets.join(need, "node").select("node", "tokens", "gs").mapInArrow(cut, "part int, node long, h binary")
    wanted = placed.mapInArrow(spread, X.schema("part", _PAIR))
    counted = tokens.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(overlaps, X.schema("part", _COUNT))
    return counted.groupBy("part").applyInArrow(together, "a long, b long")


def _overlaps(sets: list[np.ndarray], cut: int) -> np.ndarray:
    """[cut, len(sets) - cut or cut]: n-grams that each of the first cut sets shares with each of the others (of the first, if there are no others)."""
    own = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    gram, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    some = holders[gram] > 1
    own, gram = own[some], gram[some]
    # n-grams in order of their first set, so that a product's rows are the few sets that hold its n-grams
    first = np.full(len(holders), len(sets))
    np.minimum.at(first, gram, own)
    place = np.empty(len(holders), np.int64)
    place[np.argsort(first, kind="stable")] = np.arange(len(holders))
    gram = place[gram]
    order = np.argsort(gram, kind="stable")
    own, gram = own[order], gram[order]
    right = cut if cut < len(sets) else 0
    out = np.zeros((cut, len(sets) - right), dtype=np.int64)
    for lo in range(0, int(gram[-1]) + 1 if len(gram) else 0, PRODUCT_GRAMS):
        a, b = np.searchsorted(gram, (lo, lo + PRODUCT_GRAMS))
        if a == b:
            continue
        held, at = np.unique(own[a:b], return_inverse=True)
        m = np.zeros((len(held), PRODUCT_GRAMS), dtype=np.float32)
        m[at, gram[a:b] - lo] = 1
        i, j = held < cut, held >= right
        out[np.ix_(held[i], held[j] - right)] += (m[i] @ m[j].T).astype(np.int64)
    return out


def _link_counts(found: DataFrame, tokens: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """node, links: documents with other sets that link to a class's; found: (node, component), tokens: (node, tokens)."""
    inside = found.union(found.select(F.col("component").alias("node"), "component")).distinct()
    named = materialize(inside.join(classes.select("node", "n", "n_copies").hint("merge"), "node"), "linked-classes")
    blocks = named.groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS))).cast("int").alias("s"))
    placed = (named.join(blocks.hint("merge"), "component").withColumn("i", F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
              .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1))))
    total = placed.agg(F.sum("n")).first()[0] or 0
    parts = max(32, -(-total // BLOCK_GRAMS))
    placed = placed.select("node", "component", "n", F.col("n_copies").alias("w"), "i", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    units = placed.join(tokens.hint("merge"), "node").withColumn("part", F.pmod(F.xxhash64("component", "lo", "hi"), F.lit(parts)).cast("int"))

    def count(key: tuple, table: pa.Table) -> pa.Table:
        comp, lo, hi, i, node, n, w = (table.column(c).to_numpy() for c in ("component", "lo", "hi", "i", "node", "n", "w"))
        packed = table.column("tokens")
        order = np.lexsort((node, i, hi, lo, comp))
        cut = np.flatnonzero(np.concatenate([[True], np.any([v[order][1:] != v[order][:-1] for v in (comp, lo, hi)], axis=0)]))
        out = []
        for a, b in zip(cut, [*cut[1:], len(order)]):
            x = order[a:b]                                    # one unit: block lo, then block hi
            first = int((i[x] == lo[x]).sum())
            left, right = x[:first], x[first:] if lo[x[0]] < hi[x[0]] else x
            if not len(left) or not len(right):
                continue
            both = _overlaps([np.frombuffer(packed[int(r)].as_py(), "<u8") for r in x], first)
            yes = both * den >= num * (n[left][:, None] + n[right][None, :] - both)
            yes &= node[left][:, None] != node[right][None, :]
            out.append((node[left], yes @ w[right]))
            if lo[x[0]] < hi[x[0]]:
                out.append((node[right], w[left] @ yes))
        node, links = (np.concatenate(v) for v in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64())})

    return materialize(units.groupBy("part").applyInArrow(count, "node long, links long")
                       .groupBy("node").agg(F.sum("links").alias("links")), "link-counts")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_copies and (where links is set) n_links of every document.

    Documents are linked at den * overlap >= num * union of their word
    k-gram sets.  class_id is the smallest document with the same set,
    n_copies how many documents have it.  n_links is the number of other
    documents it is linked with, those of the same set included.
    """
    parts, buckets = X.sizes(docs)
    own = X.bucketed(docs, buckets)
    counts = gram_counts(docs, k)
    rank = _ranks(counts)
    pivots = _pivots(counts, rank, FRAGMENTS)

    def part_of(h):
        return ((h & T.U(0x7FFFFFFF)).astype(np.int64)) % parts

    def prefixes(batches):
        for piece in T.slices(batches):
            first, h = _sets(piece.column(1), k, rank)
            n = np.diff(first)
            take = np.where(n > 0, n - -(-n * num // den) + 1, 0)
            sums = _set_hashes(first, h)
            raw = h.astype("<u8").tobytes()
            packed = [raw[8 * a:8 * (a + m)] for a, m in zip(first[:-1].tolist(), take.tolist())]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n), *sums, pa.array(packed, pa.binary()),
                                              pa.array(_sketches(first, h), pa.binary())], names=["doc_id", "n", "s", "s2", "prefix", "sketch"])

    sets = materialize(own.select("doc_id", "text").mapInArrow(
        prefixes, "doc_id long, n long, s long, s2 long, prefix binary, sketch binary"), "sets")
    one = sets.where("n > 0").groupBy("doc_id").agg(F.min(F.struct("s", "s2", "n")).alias("x")).select("doc_id", "x.s", "x.s2", "x.n")
    classes = materialize(one.groupBy("s", "s2", "n").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n_copies")), "classes")
    reps = (classes.select("node", "s", "s2").join(sets.select(F.col("doc_id").alias("node"), "s", "s2", "n", "prefix", "sketch"), ["node", "s", "s2"])
            .dropDuplicates(["node"]))
    sketches = reps.select("node", "sketch")

    def post(batches):
        for b in batches:
            node, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            packed = b.column(2).to_pylist()
            m = np.array([len(p) // 8 for p in packed], dtype=np.int64)
            h = np.frombuffer(b"".join(packed), "<u8")
            pos = np.arange(len(h)) - np.repeat(np.cumsum(m) - m, m)
            yield X.rows("part", part_of(h), _ENTRY, [h, np.repeat(node, m), np.repeat(n, m), pos])

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        """Entries of n-grams that two or more classes have in their prefixes and that can lead to a link."""
        h, node, n, pos = X.entries(table, _ENTRY)
        some = _in_groups(*X.repeated(h))
        h, node, n, pos = h[some], node[some], n[some], pos[some]
        order = np.lexsort((node, h))
        h, node, n, pos = h[order], node[order], n[order], pos[order]
        keep = np.zeros(len(h), dtype=bool)
        for a, b in _groups(h):
            if b - a > SHORT_LIST:
                keep[a:b] = True
                continue
            x = np.arange(a, b)
            can = _may_link(n[x][:, None], pos[x][:, None], n[x][None, :], pos[x][None, :], num, den)
            np.fill_diagonal(can, False)
            keep[a:b] = can.any(axis=1)
        return X.tables([X.rows("part", np.full(int(keep.sum()), key[0].as_py()), _ENTRY, [v[keep] for v in (h, node, n, pos)])], "part", _ENTRY)

    lists = materialize(reps.select("node", "n", "prefix").mapInArrow(post, X.schema("part", _ENTRY))
                        .groupBy("part").applyInArrow(shared, X.schema("part", _ENTRY)), "lists")

    def stars(batches):
        for b in batches:
            h, node, n, pos = X.entries(pa.Table.from_batches([b]), _ENTRY)
            order = np.lexsort((node, h))
            h, node, n, pos = h[order], node[order], n[order], pos[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            hub = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.arange(0)
            yes = np.flatnonzero((node[hub] != node) & _may_link(n[hub], pos[hub], n, pos, num, den)) if len(h) else hub
            at = hub[yes]
            yield _pair_rows(node[at], node[yes], n[at], n[yes])

    def full_sets(key: tuple, texts: pa.Table, want: pa.Table) -> pa.Table:
        schema = pa.schema([("node", pa.int64()), ("tokens", pa.binary())])
        out = []
        known = dict(zip(want.column("node").to_pylist(), want.column("s").to_pylist()))
        hit = np.isin(texts.column("doc_id").to_numpy(), np.array(list(known), dtype=np.int64)) if known else np.zeros(texts.num_rows, bool)
        for piece in T.slices(texts.filter(pa.array(hit)).combine_chunks().to_batches()):
            ids = piece.column(piece.schema.get_field_index("doc_id")).to_pylist()
            first, h = _sets(piece.column(piece.schema.get_field_index("text")), k, rank)
            for node, a, b in zip(ids, first[:-1].tolist(), first[1:].tolist()):
                s = int(np.add.reduce(T.mix(h[a:b] ^ T.U(0x5851F42D4C957F2D))).astype(np.uint64).view(np.int64)) if b > a else 0
                if known.get(node) == s:                  # of rows that repeat an id, the one that stands for it
                    known.pop(node)
                    out.append((node, h[a:b].astype("<u8").tobytes()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema) if out else schema.empty_table()

    def members(nodes: DataFrame) -> DataFrame:
        """node, tokens: the whole sets of some nodes, from their texts."""
        wanted = (nodes.join(classes.select("node", "s").hint("merge"), "node").select("node", "s")
                  .withColumn("bucket", X.bucket_of(F.col("node"), buckets)))
        return materialize(own.select("doc_id", "text", "bucket").groupBy("bucket").cogroup(wanted.groupBy("bucket"))
                           .applyInArrow(full_sets, "node long, tokens binary"), "members")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()

    # first round: each list's smallest document with the others
    pair = "a long, b long, na int, nb int"
    close = _close(lists.mapInArrow(stars, pair).distinct(), sketches, num, den)
    tokens = members(ends(close))
    found = components(materialize(_verify(close, tokens, rank, pivots, num, den), "links"))

    # second round: candidates of different components
    labelled = materialize(sketches.join(found.hint("merge"), "node", "left")
                           .select("node", "sketch", F.coalesce("component", "node").alias("comp")), "labelled")

    def entry_rows(batches):
        for b in batches:
            h, node, n, pos = X.entries(pa.Table.from_batches([b]), _ENTRY)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(node), pa.array(n), pa.array(pos)], names=["h", "node", "n", "pos"])

    def send_full(batches):
        for b in batches:
            node, h, n, pos, sketch, comp = b.columns
            h = h.to_numpy().view(np.uint64)
            s = _words(sketch.to_pylist())
            s = s[:, 0:4] ^ s[:, 4:8] ^ s[:, 8:12] ^ s[:, 12:16]              # folded parities stay parities
            yield X.rows("part", part_of(h), _FULL, [h, node.to_numpy(), n.to_numpy(), pos.to_numpy(), comp.to_numpy(), *s.T])

    def across(key: tuple, table: pa.Table) -> pa.Table:
        h, node, n, pos, comp, *s = X.entries(table, _FULL)
        order = np.lexsort((node, comp, h))
        h, node, n, pos, comp = (v[order] for v in (h, node, n, pos, comp))
        s = np.stack([v[order] for v in s], axis=1)
        out = []
        for a, b in _groups(h):
            if comp[a] == comp[b - 1]:
                continue
            step = max(1, 4_000_000 // (b - a) // 8)
            for lo in range(a, b, step):                      # rows in blocks; a row meets the later ones of other components
                x = np.arange(lo, min(b, lo + step))
                y = np.arange(lo, b)
                can = (comp[x][:, None] != comp[y][None, :]) & (x[:, None] < y[None, :])
                can &= _may_link(n[x][:, None], pos[x][:, None], n[y][None, :], pos[y][None, :], num, den)
                i, j = np.nonzero(can)
                if not len(i):
                    continue
                i, j = x[i], y[j]
                near = _near(s[i], s[j], n[i], n[j], num, den)
                out.append((i[near], j[near]))
        if not out:
            return pa.table({c: pa.array([], t) for c, t in (("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("nb", pa.int32()))})
        i, j = (np.concatenate(v) for v in zip(*out))
        return pa.Table.from_batches([_pair_rows(node[i], node[j], n[i], n[j])])

    entries = lists.mapInArrow(entry_rows, "h long, node long, n int, pos int")
    rest = _close(entries.join(labelled.hint("merge"), "node").select("node", "h", "n", "pos", "sketch", "comp").mapInArrow(send_full, X.schema("part", _FULL))
                  .groupBy("part").applyInArrow(across, pair).distinct(), sketches, num, den)
    if rest.first() is not None:
        tokens = tokens.union(members(ends(rest).join(tokens.select("node"), "node", "left_anti")))
        more = materialize(_verify(rest, tokens, rank, pivots, num, den), "links")
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    extra = ["n_links"] if links else []
    if links:
        counted = _link_counts(found, tokens, classes, num, den)
        classes = (classes.join(counted.hint("merge"), "node", "left")
                   .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).drop("links"))
    by_class = classes.join(found, "node", "left").select("s", "s2", "n", F.col("node").alias("class_id"), "n_copies",
                                                          F.coalesce("component", "node").alias("component_id"), *extra)
    by_doc = one.join(by_class, ["s", "s2", "n"]).select("doc_id", "component_id", "class_id", "n_copies", *extra)
    real = lambda c: F.when(F.col(c) != X.NO_ID, F.col(c))
    return (sets.select("doc_id", F.col("n").alias("n_shingles")).join(by_doc, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
                    *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in extra])
            .select(real("doc_id").alias("doc_id"), "n_shingles", real("component_id").alias("component_id"), real("class_id").alias("class_id"), "n_copies", *extra))


def _pair_rows(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> pa.RecordBatch:
    """Pairs with the smaller node first, each once."""
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    order, new = X.repeated(a, b)
    k = order[new]
    return pa.RecordBatch.from_arrays([pa.array(a[k]), pa.array(b[k]), pa.array(na[k].astype(np.int32)), pa.array(nb[k].astype(np.int32))],
                                      names=["a", "b", "na", "nb"])
