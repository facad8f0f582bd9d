"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label.  Every passage is
encoded (hashed words through a fixed random projection, and figures of its form),
a learned layer turns the encoding into h, gated attention
``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the passages of a document, and a
logistic unit scores the weighted sum.  All layers are learned together from the
document labels by gradient descent (Adam).
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

#: Bounds of the sample that the model is fitted on: labelled rows, and passages of one of them (spread evenly).
FIT_ROWS, FIT_PASSAGES = 8000, 128
#: Words of a passage, hashed words, width of their projection, of h and of the attention.
WORDS, BUCKETS, PROJECTED, HIDDEN, GATE = 64, 1024, 48, 32, 16
EPOCHS, BAGS, RATE, DECAY = 12, 64, 3e-3, 1e-4
THRESHOLD = 0.3

_project = (np.random.default_rng(41).standard_normal((BUCKETS, PROJECTED)) / np.sqrt(PROJECTED)).astype(np.float32)
# byte classes: lower, upper, digit, symbol, stop, line break, blank, other; a byte has one
_CLASS = np.full(256, 7, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_CLASS[[ord(c) for c in ".,;:?"]], _CLASS[[10, 13]], _CLASS[[32, 9, 11, 12]] = 4, 5, 6
FORM = 8 + 7
WIDTH = PROJECTED + FORM


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(encoded passages, passages of each text); a text without words is one passage of zeros."""
    buf, bounds = T.joined(texts)
    starts, ends = T.word_spans(buf)
    first = T.per_text(starts, bounds)
    words = np.diff(first)
    n = np.maximum(1, -(-words // WORDS))
    lo = np.repeat(first[:-1], n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * WORDS
    hi = np.minimum(lo + WORDS, np.repeat(first[1:], n))
    x = np.zeros((len(lo), WIDTH), dtype=np.float32)
    full = np.flatnonzero(hi > lo)
    if not len(full):
        return x, n
    a, b = lo[full], hi[full]
    which = np.repeat(np.arange(len(full)), b - a)          # the passage of every word; passages follow each other without gaps
    size = (b - a).astype(np.float32)
    h = T.word_hashes(T.LOWER[buf], starts, ends)
    for s in range(0, len(full), 2048):                     # counts of hashed words, in blocks of passages
        e = min(s + 2048, len(full))
        inside = slice(a[s], b[e - 1])
        cell = (which[inside] - s) * BUCKETS + (h[inside] % T.U(BUCKETS)).astype(np.int64)
        counts = np.sqrt(np.bincount(cell, minlength=(e - s) * BUCKETS).reshape(e - s, BUCKETS).astype(np.float32))
        x[full[s:e], :PROJECTED] = (counts @ _project) / np.sqrt(size[s:e])[:, None]
    kinds = _CLASS[buf]
    total = (ends[b - 1] - starts[a] + 1).astype(np.float32)
    for k in range(8):
        upto = np.concatenate([[0], np.cumsum(kinds == k)])
        x[full, PROJECTED + k] = (upto[np.minimum(ends[b - 1] + 1, len(buf))] - upto[starts[a]]) / total
    long = np.minimum(ends - starts, 64).astype(np.float64)
    again = np.concatenate([[False], h[1:] == h[:-1]])
    again[a] = False
    pair = np.unique(np.stack([which.astype(np.uint64), h]), axis=1)[0]
    only = kinds[starts]                                    # class of a word's first byte
    form = (np.add.reduceat(long, a) / size / 8, np.sqrt(np.add.reduceat(long ** 2, a) / size) / 8,
            np.bincount(pair.astype(np.int64), minlength=len(full)) / size, np.add.reduceat(again.astype(np.float64), a) / size,
            np.add.reduceat((only == 3).astype(np.float64), a) / size, np.add.reduceat((kinds[ends - 1] == 3).astype(np.float64), a) / size,
            np.log1p(size) / np.log1p(WORDS))
    for i, v in enumerate(form):
        x[full, PROJECTED + 8 + i] = v
    return x, n


def _sigmoid(v):
    return 1.0 / (1.0 + np.exp(-np.clip(v, -30, 30)))


def _per_bag(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(v, at, axis=0)


class Model:
    """The learned layers; forward() and step() work on the passages of many bags at once."""

    SHAPES = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts

    @classmethod
    def fresh(cls, x: np.ndarray, share: float) -> Model:
        rng = np.random.default_rng(7)
        parts = {k: (rng.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else np.zeros(s)) for k, s in cls.SHAPES.items()}
        parts["w"] = rng.standard_normal(GATE) / np.sqrt(GATE)
        parts["c"] = rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN)
        parts["d"] = np.array([np.log(share / (1 - share))])
        parts |= {"mean": x.mean(axis=0), "std": x.std(axis=0) + 1e-3}
        return cls({k: v.astype(np.float64) for k, v in parts.items()})

    def forward(self, x: np.ndarray, n: np.ndarray):
        p = self.parts
        at = np.cumsum(n) - n
        z = np.clip((x - p["mean"]) / p["std"], -8, 8)
        h = np.tanh(z @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(_per_bag(e, at), n)
        bag = _per_bag(a[:, None] * h, at)
        return at, z, h, t, g, a, bag, _sigmoid(bag @ p["c"] + p["d"][0])

    def gradient(self, x, n, y):
        p = self.parts
        at, z, h, t, g, a, bag, score = self.forward(x, n)
        ds = (score - y) / len(y)
        dbag = np.repeat(ds, n)[:, None] * p["c"]
        da = (dbag * h).sum(axis=1)
        de = a * (da - np.repeat(_per_bag(a * da, at), n))
        dt, dg = de[:, None] * p["w"] * g, de[:, None] * p["w"] * t
        dpt, dpg = dt * (1 - t ** 2), dg * g * (1 - g)
        dh = a[:, None] * dbag + dpt @ p["V"].T + dpg @ p["U"].T
        dz = dh * (1 - h ** 2)
        return {"W": z.T @ dz, "b": dz.sum(axis=0), "V": h.T @ dpt, "U": h.T @ dpg, "w": (t * g).T @ de, "c": bag.T @ ds, "d": np.array([ds.sum()])}

    def scores(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.forward(x, n)[-1]

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.parts)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as z:
            return cls({k: z[k] for k in z.files})


def learn(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> Model:
    """Fit the model on bags of n passages with labels y (0 and 1)."""
    share = float(np.clip(y.mean(), 0.01, 0.99))
    model = Model.fresh(x, share)
    if share in (0.01, 0.99):                               # one class only: its share is all there is to say
        model.parts["c"][:] = 0
        return model
    rng = np.random.default_rng(11)
    at = np.cumsum(n) - n
    m = {k: np.zeros(s) for k, s in Model.SHAPES.items()}
    v = {k: np.zeros(s) for k, s in Model.SHAPES.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(n))
        for s in range(0, len(n), BAGS):
            pick = order[s:s + BAGS]
            k = n[pick]
            rows = np.repeat(at[pick] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            step += 1
            for name, grad in model.gradient(x[rows], k, y[pick]).items():
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad ** 2
                move = m[name] / (1 - 0.9 ** step) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
                model.parts[name] -= RATE * (move + DECAY * model.parts[name])
    return model


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, allowed, fit_rows: int = FIT_ROWS) -> Model | None:
    """Learn from at most ``fit_rows`` labelled documents whose id ``allowed`` accepts (those of the smallest id hash).

    Their passages are encoded where their texts are read; the model is fitted in one task on that bounded
    sample, and only its weights (some 30 KB) come back.  None without a labelled document.
    """
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(allowed(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"))
    # twice as many ids, as a label need not have a document; both are bounded
    wanted = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * fit_rows)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches):
            x, n = encode(b.column(1))
            at = np.cumsum(n) - n
            rows = [x[s:s + k] if k <= FIT_PASSAGES else x[s + np.arange(FIT_PASSAGES) * k // FIT_PASSAGES] for s, k in zip(at.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "y", "x"])

    encoded = _texts(docs).join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "y").mapInArrow(passages, "doc_id long, y int, x binary")
    sample = encoded.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(fit_rows).coalesce(1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [], []
        for b in batches:
            xs += [np.frombuffer(v, dtype=np.float32).reshape(-1, WIDTH) for v in b.column("x").to_pylist()]
            ys += b.column("y").to_pylist()
        if ys:
            model = learn(np.concatenate(xs), np.array([len(v) for v in xs]), np.array(ys, dtype=np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([model.pack()], pa.binary())], names=["model"])

    row = sample.mapInArrow(fit, "model binary").first()
    return Model.unpack(bytes(row[0])) if row else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= 0.3) of every whole text; without a model the score is 0.5."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches):
            s = model.scores(*encode(b.column(1))) if model else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return _texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; learned from labels outside the held-out fold.

    The fold is crc32(doc_id as text) mod ``folds``.  A null or empty text is one empty passage and gets that
    passage's score; a null id is not held out and never learned from; a label that is null or neither 0 nor 1
    is skipped, of several for one id the smaller counts.  Rows that repeat an id are scored each by its own
    text.  No documents: no rows; no labels: 0.5 everywhere; one class only: its share.  Of the tables only doc_id, text and
    quality are read.
    """
    fold = lambda c: F.crc32(c.cast("string").cast("binary")) % folds
    model = train(docs, labels, lambda c: fold(c) != held)
    return score(docs, model).select("doc_id", F.coalesce(fold(F.col("doc_id")) == held, F.lit(False)).alias("held_out"), "score", "predicted")
