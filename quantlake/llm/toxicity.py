"""Toxicity by two class-conditional Kneser-Ney models that share their lowest order.

A class's model of a word w after the word v before it backs off twice:

    P_c(w | v) = (max(n_c(v, w) - D_c, 0) + L_c(v) P_c(w)) / n_c(v, .)
    P_c(w)     = (max(N_c(., w) - D_c, 0) + L_c P(w)) / N_c(., .)

n_c counts the class's training documents that hold the pair (so no single document
vouches for its own words), N_c(., w) is the continuation count, the number of different
words that w follows in class c, and L is the mass that the discount frees.  The lowest
order P(w), continuation counts over both classes, is shared.  The discount is DISCOUNT
documents of the smaller class and as many more of the larger one as that has documents;
larger than the usual one, as the words of a document come together.

A document's features are the difference of its toxic and ordinary log-likelihood and the
part of it by words that decide, by length and by its root.  Where a pair has no count above its discount the difference is the sum of a
part of v and one of w, the shared P(w) cancelling out, so the model is a table of one value
a word and one a pair with counts above the discount.  All counts are exact, made by
pre-aggregation and a shuffle in groups of about PART_BYTES of text, and the table grows with the corpus.  Documents find its
HOT most frequent entries in a broadcast and a bit map of BITS bits tells which other
expressions may be in the table; those travel to the table's parts, packed by piece of text, and come back the same way: a row for a row,
with one sum for each of its documents that has a hit, so answers are never more than what was asked, and that at most an entry an expression.

A logistic curve makes the features a score.  It is fitted to at most FIT_ROWS training
rows, by a second model from which these rows' own counts are left out.

Words are told apart by 48 bits of a hash, pairs by 64.

Defined results: a null or empty text has the score of no words at all;
repeated rows get equal scores; label rows that repeat an id count once, as toxic if
any says so, and those with null id or label not at all; without training
rows of both classes every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.session import materialize

from . import exchange as E
from . import textops as T

#: Labelled rows that the logistic curve is fitted to at most, a share of one in FIT_SHARE (those with the smallest id hash).
FIT_ROWS, FIT_SHARE = 10_000, 4
#: Entries of the model that are broadcast at most (2 MB), and bits of a map of ids or entries (4 MB).
HOT, BITS = 1 << 17, 1 << 25
#: Documents of the smaller class that are taken off each of its counts.
DISCOUNT = 3.0
#: Share of the greatest difference that the model can give a word from which a word decides.
DECISIVE = 0.7
N_FEATURES = 2
THRESHOLD = 0.7
_BIN = 1 << 15                                   # bits of one row of the map
_WORD = T.U((1 << 48) - 1)
_BEGIN, _END = T.U(1), T.U(2)                    # the word before the first and the one after the last
_SIDES = 4                                       # groups of counts: so many by each of the pair's words, all of that by the pair
_ENTRY = {"vl": "<u4", "vh": "<u2", "wl": "<u4", "wh": "<u2", "cat": "u1", "n": "<u4"}
_ASK = {"key": "<i8", "doc": "<u4"}
_ANSWER = {"doc": "<u4", "x": "<f8", "decides": "<u4", "s": "<f8"}              # s is 0 for most documents, so those it decides are named

#: Everything but ASCII letters, digits and bytes of other alphabets parts words.
_PARTS = np.ones(256, dtype=bool)
_PARTS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Key of a pair; its highest bit is set, a word's (48 bits) never."""
    return T.mix(v * T.U(0x9E3779B97F4A7C15) + T.mix(w)) | T.U(1 << 63)


def _expressions(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, v, w, key, words): every pair of a document, from its beginning to its end; words counts them by document."""
    buf, bounds = T.joined(texts)
    buf = T.LOWER[buf]
    starts, ends = T.word_spans(buf, _PARTS)
    first = T.per_text(starts, bounds)
    h = T.word_hashes(buf, starts, ends) & _WORD
    many = len(first) - 1
    words = np.diff(first)
    doc = np.repeat(np.arange(many), words + 1)
    at = np.arange(len(doc)) - doc                        # index of the pair's second word
    last = np.cumsum(words + 1) - 1
    w, v = np.empty(len(doc), dtype=np.uint64), np.empty(len(doc), dtype=np.uint64)
    inner = np.ones(len(doc), dtype=bool)
    inner[last] = False
    w[inner], w[last] = h[at[inner]], _END
    v[1:] = w[:-1]
    v[last - words] = _BEGIN
    return doc, v, w, _pair_key(v, w), words


def _part(v: np.ndarray, w: np.ndarray, key: np.ndarray, parts: int) -> np.ndarray:
    """Group of counts of a pair.  A word's pairs fill a _SIDES-th of the groups on either side, so that more and smaller groups
    don't make more partial sums; the pair deals them out in there, so that no word has a group of its own."""
    within = max(1, parts // _SIDES ** 2)
    side = T.mix(v) % T.U(_SIDES) * T.U(_SIDES) + T.mix(w) % T.U(_SIDES)
    return (side * T.U(within) + (key >> T.U(2)) % T.U(within)).astype(np.int64)


def _gather(training: DataFrame, parts: int, discount: tuple[float, float]) -> DataFrame:
    """Exact counts of the training rows (text, label, fit), written to the shared folder.

    Rows (key, v, w, a0..a7), partial sums of one kind each, with all rows in a0..a3 and without those of the curve in a4..a7:
    a pair above its discount (key, v, w; n_0, n_1), a context (v; n_0, n_1, freed mass of both), a word (w; continuation counts
    of class 0, 1 and both classes together).
    """
    def add(batches):
        for piece in T.slices(batches, size=2 * T.PIECE):
            label = np.asarray(piece.column(1).to_numpy(zero_copy_only=False), dtype=np.uint8)
            fit = np.asarray(piece.column(2).to_numpy(zero_copy_only=False), dtype=np.uint8)
            doc, v, w, key, _ = _expressions(piece.column(0))
            one = np.unique(T.mix(key + doc.astype(np.uint64) * T.U(0xD6E8FEB86659FD93)), return_index=True)[1]   # once a document
            kind = (label + 2 * fit)[doc[one]]
            _, at, n = np.unique((key[one] & ~T.U(3)) | kind.astype(np.uint64), return_index=True, return_counts=True)
            cat, at = kind[at], one[at]
            v, w, key = v[at], w[at], key[at]
            del doc, one, kind, at
            yield E.rows("part", _part(v, w, key, parts), _ENTRY, [v & T.U(0xFFFFFFFF), v >> T.U(32), w & T.U(0xFFFFFFFF), w >> T.U(32), cat, n])

    columns = [f"a{i}" for i in range(8)]

    def total(key: tuple, table: pa.Table) -> pa.Table:
        vl, vh, wl, wh, cat, n = E.entries(table, _ENTRY)
        v = vl.astype(np.uint64) | vh.astype(np.uint64) << T.U(32)
        w = wl.astype(np.uint64) | wh.astype(np.uint64) << T.U(32)
        order, new = E.repeated(v, w)
        group = np.cumsum(new) - 1
        v, w = v[order][new], w[order][new]
        by_cat = np.zeros((4, len(v)))
        np.add.at(by_cat, (cat[order], group), n[order])
        own = [by_cat[0] + by_cat[2], by_cat[1] + by_cat[3], by_cat[0], by_cat[1]]       # all rows; without the curve's
        freed = [np.minimum(x, discount[c % 2]) for c, x in enumerate(own)]
        out = []

        def sums(by: np.ndarray, values: list[np.ndarray | None], name: str):
            ids, where = np.unique(by, return_inverse=True)
            add = [np.zeros(len(ids)) if x is None else np.bincount(where, weights=x, minlength=len(ids)) for x in values]
            out.append(rows(**{name: ids}, values=add))

        def rows(values, key=None, v=None, w=None):
            size = len(values[0])
            ids = [pa.nulls(size, pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (key, v, w)]
            return pa.table([*ids, *(pa.array(x, pa.float64()) for x in values)], names=["key", "v", "w", *columns])

        sums(v, [own[0], own[1], freed[0], freed[1], own[2], own[3], freed[2], freed[3]], "v")
        seen = [(x > 0).astype(float) for x in own]
        sums(w, [seen[0], seen[1], np.maximum(seen[0], seen[1]), None, seen[2], seen[3], np.maximum(seen[2], seen[3]), None], "w")
        above = np.any([x > discount[c % 2] for c, x in enumerate(own)], axis=0)
        zero = np.zeros(int(above.sum()))
        own = [x[above] for x in own]
        out.append(rows([own[0], own[1], zero, zero, own[2], own[3], zero, zero], _pair_key(v[above], w[above]), v[above], w[above]))
        return pa.concat_tables(out)

    entries = training.mapInArrow(add, E.schema("part", _ENTRY))
    schema = "key long, v long, w long, " + ", ".join(f"{c} double" for c in columns)
    return materialize(entries.groupBy("part").applyInArrow(total, schema), "toxicity-counts")


def _differences(gathered: DataFrame, discount: tuple[float, float]) -> tuple[DataFrame, list[float]]:
    """(key, n, x0, s0, x1, s1 of every entry of the model, and what an unknown word adds by either).

    x is the part of the log-likelihood difference, s that of a word that decides; 0 with all rows, 1 without the curve's.
    """
    total = {f"a{i}": F.sum(f"a{i}").alias(f"a{i}") for i in range(8)}
    contexts = gathered.where("v IS NOT NULL AND w IS NULL").groupBy("v").agg(*total.values())
    words = materialize(gathered.where("w IS NOT NULL AND v IS NULL").groupBy("w").agg(*total.values()), "toxicity-words")
    mass = words.agg(*(F.sum(f"a{i}").alias(f"n{i}") for i in (0, 1, 2, 4, 5, 6)), F.count(F.lit(1)).alias("types"),
                     *(F.sum(F.least(F.col(f"a{i}"), F.lit(float(discount[i % 2])))).alias(f"l{i}") for i in (0, 1, 4, 5))).first()

    def lower(model: int, c: int):
        """P_c(w) by P(w), so that an unknown word has the freed share: max(N_c - D, 0) / (P(w) N_c(., .)) + L_c."""
        n, both = mass[f"n{4 * model + c}"] or 1.0, (mass[f"n{4 * model + 2}"] or 1.0) + mass["types"] + 1.0
        shared = (F.coalesce(F.col(f"w.a{4 * model + 2}"), F.lit(0.0)) + 1.0) / both
        return (F.greatest(F.coalesce(F.col(f"w.a{4 * model + c}"), F.lit(0.0)) - discount[c], F.lit(0.0)) / shared + freed(model, c) * n) / n, shared

    def freed(model: int, c: int) -> float:
        return (mass[f"l{4 * model + c}"] or 1.0) / (mass[f"n{4 * model + c}"] or 1.0)

    def back(model: int, c: int):
        """Share of the mass that a context leaves to the lower order; all of it where the context is new."""
        n = F.coalesce(F.col(f"v.a{4 * model + c}"), F.lit(0.0))
        return F.when(n > 0, F.col(f"v.a{4 * model + 2 + c}") / n).otherwise(1.0)

    unknown = [float(np.log(freed(m, 1) / freed(m, 0))) for m in (0, 1)]

    def decisive(m: int) -> float:
        both = (mass[f"n{4 * m + 2}"] or 1.0) + mass["types"] + 1.0
        return DECISIVE * float(np.log((both / (mass[f"n{4 * m + 1}"] or 1.0) + freed(m, 1)) / freed(m, 0)))

    def word_values(m: int):
        own = F.log(lower(m, 1)[0]) - F.log(lower(m, 0)[0])
        before = F.log(back(m, 1)) - F.log(back(m, 0))
        return [(own + before - unknown[m]).alias(f"x{m}"), F.when(own > decisive(m), own).otherwise(0.0).alias(f"s{m}")]

    def pair_values(m: int):
        logs = []
        for c in (1, 0):
            p, shared = lower(m, c)
            n = F.greatest(F.coalesce(F.col(f"v.a{4 * m + c}"), F.lit(0.0)), F.lit(1.0))
            above = F.greatest(F.col(f"p.a{4 * m + c}") - discount[c], F.lit(0.0)) / n
            logs.append(F.log1p(above / (back(m, c) * p * shared)))       # over what backing off alone gives
        return [(logs[0] - logs[1]).alias(f"x{m}"), F.lit(0.0).alias(f"s{m}")]

    contexts, words = contexts.alias("v"), words.alias("w")
    single = words.join(contexts, F.col("w.w") == F.col("v.v"), "full").select(
        F.coalesce("w.w", "v.v").alias("key"), (F.coalesce("v.a0", F.lit(0.0)) + F.coalesce("v.a1", F.lit(0.0))).alias("n"),
        *word_values(0), *word_values(1))
    pairs = gathered.where("key IS NOT NULL").alias("p")
    double = (pairs.join(contexts, F.col("p.v") == F.col("v.v"), "left").join(words, F.col("p.w") == F.col("w.w"), "left")
              .select(F.col("p.key").alias("key"), (F.col("p.a0") + F.col("p.a1")).alias("n"), *pair_values(0), *pair_values(1)))
    return single.union(double), unknown


@dataclass
class Model:
    """table: key, n, x0, s0, x1, s1 (written); its entries from ``least`` on are in hot; bits marks the others."""

    table: DataFrame
    least: int
    hot: tuple[np.ndarray, np.ndarray]
    bits: np.ndarray
    unknown: list[float]
    curve: np.ndarray


def _bit(key):
    """Place of a key in the bit map."""
    return F.pmod(F.shiftright(key, 7), F.lit(BITS))


def _marks(rows: DataFrame, key) -> DataFrame:
    """(bin, bits): the bit map of the rows' keys, at most BITS / _BIN rows of 4 KB."""
    place = _bit(key)
    return (rows.select(F.floor(place / _BIN).cast("int").alias("bin"), (place % _BIN).alias("at"))
            .groupBy("bin").agg(F.bitmap_construct_agg("at").alias("bits")))


def _perhaps_in(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose doc_id a bit map of the ids of known doesn't rule out, so that few others move to the join."""
    place = _bit(F.xxhash64("doc_id"))
    marks = F.broadcast(_marks(known, F.xxhash64("doc_id")))                       # 4 MB at most
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(at DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    found = rows.withColumn("bin", F.floor(place / _BIN).cast("int")).withColumn("at", (place % _BIN).cast("int")).join(marks, "bin")
    return found.withColumn("byte", byte).where("shiftright(byte, at % 8) % 2 = 1").select(*rows.columns)


def _model(table: DataFrame, unknown: list[float]) -> Model:
    step = F.floor(F.log2(F.col("n") + 1) * 8).cast("int")
    counted = sorted(((r[0], r[1]) for r in table.groupBy(step.alias("step")).count().collect()), reverse=True)
    least, held = 1 << 30, 0
    for s, n in counted:
        if held + n > HOT:
            break
        least, held = s, held + n
    names = ("x0", "s0", "x1", "s1")
    hot = table.where(step >= least).select("key", *(F.col(c).cast("float") for c in names)).toArrow().sort_by("key")
    rows = _marks(table.where(step < least), F.col("key")).collect()
    bits = np.zeros((BITS // _BIN, _BIN // 8), dtype=np.uint8)
    for r in rows:
        bits[r["bin"]] = np.frombuffer(r["bits"], np.uint8)
    values = np.column_stack([hot.column(c).to_numpy() for c in names])
    return Model(table, least, (hot.column("key").to_numpy(), values), bits.ravel(), unknown, np.zeros(1 + N_FEATURES))


def _sums(docs: DataFrame, model: Model, which: int, parts: int) -> DataFrame:
    """doc_id, text_hash, label, words, x, s of every row of docs (doc_id, text_hash, label, text).

    which: 0 by the counts of all training rows, 1 by those without the curve's.
    """
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast((model.hot[0], model.hot[1][:, 2 * which:2 * which + 2].copy(), model.bits))
    unknown = model.unknown[which]

    def ask(batches):
        hot, values, bits = held.value
        piece_id = TaskContext.get().partitionId() << 32
        for piece in T.slices(batches):
            many = piece.num_rows
            doc, _, w, pair, words = _expressions(piece.column(3))
            key = np.concatenate([w, pair, np.full(many, _BEGIN)]).view(np.int64)     # a word's value is also that of the context it makes
            doc = np.concatenate([doc, doc, np.arange(many)])
            at = np.minimum(np.searchsorted(hot, key), max(len(hot) - 1, 0))
            known = hot[at] == key if len(hot) else np.zeros(len(key), dtype=bool)
            x, s = (np.bincount(doc[known], weights=values[at[known], k], minlength=many).astype(np.float64) for k in (0, 1))
            key, doc = key[~known], doc[~known]
            place = (key >> 7) & (BITS - 1)
            maybe = (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            key, doc = key[maybe], doc[maybe]
            asked = E.rows("part", key % parts, _ASK, [key, doc])
            n = len(asked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(many, piece_id)), pa.array(np.arange(many, dtype=np.int32)), *piece.columns[:3], pa.array(words.astype(np.int64)),
                 pa.array(x + unknown * (words + 1)), pa.array(s), *(pa.nulls(many, t) for t in (pa.int32(), pa.binary(), pa.binary()))], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, piece_id)), *(pa.nulls(n, t) for t in kinds), *asked.columns], names=names)
            piece_id += 1

    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
    names = ["piece", "row", "doc_id", "text_hash", "label", "words", "x", "s", "part", "key", "doc"]
    asked = materialize(docs.select("doc_id", "text_hash", "label", "text").mapInArrow(
        ask, "piece long, row int, doc_id long, text_hash long, label int, words long, x double, s double, part int, key binary, doc binary"), "toxicity-asked")
    held.unpersist()
    step = F.floor(F.log2(F.col("n") + 1) * 8).cast("int")
    rest = model.table.where(step < model.least).select(F.pmod("key", F.lit(parts)).cast("int").alias("part"), "key",
                                                        F.col(f"x{which}").alias("x"), F.col(f"s{which}").alias("s"))
    answers = (asked.where("part IS NOT NULL").select("piece", "part", "key", "doc").groupBy("part").cogroup(rest.groupBy("part"))
               .applyInArrow(_answer, "piece long, " + ", ".join(f"{c} binary" for c in _ANSWER)))
    own = ("doc_id", "text_hash", "label", "words")

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("row")
        doc, x, decides, s = E.entries(right, _ANSWER)
        sums = [left.column(c).to_numpy() + np.bincount(at, weights=v, minlength=len(left)) for c, at, v in (("x", doc, x), ("s", decides, s))]
        return pa.table({**{c: left.column(c) for c in own}, "x": pa.array(sums[0]), "s": pa.array(sums[1])})

    heads = asked.where("part IS NULL").select("piece", "row", *own, "x", "s")
    return (heads.groupBy("piece").cogroup(answers.groupBy("piece"))
            .applyInArrow(total, "doc_id long, text_hash long, label int, words long, x double, s double"))


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of each asked row (piece, part, key, doc) that has hits in the part's entries (key, x, s) one row: the sums of its documents."""
    key, doc = E.entries(left, _ASK)
    own = right.sort_by("key")
    known = own.column("key").to_numpy()
    of = np.repeat(np.arange(len(left)), [len(b) // 4 for b in left.column("doc").to_pylist()])
    place = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
    hit = known[place] == key if len(known) else np.zeros(len(key), dtype=bool)
    ids, where = np.unique(of[hit] << 32 | doc[hit], return_inverse=True)
    x, s = (np.bincount(where, weights=own.column(c).to_numpy()[place[hit]], minlength=len(ids)).astype(np.float64) for c in ("x", "s"))
    rows, begin = np.unique(ids >> 32, return_index=True)
    pieces, ids, some = left.column("piece").to_numpy()[rows], ids & 0xFFFFFFFF, np.flatnonzero(s)
    ends = np.append(begin[1:], len(ids))
    columns = []
    for (_, kind), v, a, b in zip(_ANSWER.items(), (ids, x, ids[some], s[some]), (begin, begin, *[np.searchsorted(some, begin)] * 2),
                                  (ends, ends, *[np.searchsorted(some, ends)] * 2)):
        v = v.astype(kind)
        columns.append(pa.array([v[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist())], pa.binary()))
    return pa.table([pa.array(pieces, pa.int64()), *columns], names=["piece", *_ANSWER])


def _features() -> list:
    n = F.col("words") + 5.0
    return [(F.col("x") / n).alias("f0"), (F.col("s") / F.sqrt(n)).alias("f1")]


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve by Newton steps with a small ridge, over standardised features."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(a.shape[1]), a.T @ (y - p) - 1e-3 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return np.array([w[0], *(w[1:] / scale)])


def held_out(doc_id):
    """True for the documents whose labels nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from the labelled rows outside the held-out third; None unless both classes occur."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("toxic") != 0).cast("int")).alias("label")).where(~held_out(F.col("doc_id"))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["label"]: r["n"] for r in known.join(texts.select("doc_id"), "doc_id").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    discount = tuple(DISCOUNT * counts[c] / min(counts.values()) for c in (0, 1))
    parts, _ = E.sizes(docs)
    texts = _perhaps_in(texts, known)
    some = (known.where(F.pmod(F.xxhash64("doc_id"), F.lit(FIT_SHARE)) == 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
            .select("doc_id", F.lit(True).alias("fit")))
    known = known.join(some, "doc_id", "left").select("doc_id", "label", F.coalesce("fit", F.lit(False)).alias("fit"))
    # texts move once, to their labels; the hint keeps one plan at every size
    training = texts.join(known.hint("merge"), "doc_id").select("text", "label", "fit")
    table, unknown = _differences(_gather(training, parts, discount), discount)
    model = _model(materialize(table, "toxicity-model"), unknown)
    rows = texts.join(F.broadcast(known.where("fit")), "doc_id").select(           # at most FIT_ROWS ids
        "doc_id", F.xxhash64("text").alias("text_hash"), "label", "text")
    fitted = _sums(rows, model, 1, parts).select(*_features(), "label").toPandas()
    names = [f"f{k}" for k in range(N_FEATURES)]
    fitted = fitted.sort_values([*names, "label"])
    model.curve = _curve(fitted[names].to_numpy(), fitted["label"].to_numpy(dtype=np.float64))
    return model


def scored(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, score and predicted of every row; the text alone decides."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(None).cast("int").alias("label"), "text")
    if model is None:
        return own.select("doc_id", "text_hash", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    z = F.lit(float(model.curve[0]))
    for f, c in zip(_features(), model.curve[1:]):
        z = z + f * float(c)
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return (_sums(own, model, 0, E.sizes(docs)[0]).select("doc_id", "text_hash", F.round(score, 12).alias("score"))   # sums of another order agree
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all their columns, whose score stays below the threshold."""
    toxic = scored(docs, model, threshold).where("predicted = 1").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("hash"))
    return rows.join(toxic, same, "left_anti").select("row.*")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(docs, train(docs, labels), threshold).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
