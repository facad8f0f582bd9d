"""The toxicity models against Kneser-Ney written out plainly, and the ways an expression finds its value."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import frame, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from quantlake.llm import exchange as E
from quantlake.llm import textops as T
from quantlake.llm import toxicity
from quantlake.session import materialize


def _corpus():
    rnd = random.Random(11)
    plain, bad = [f"w{int(rnd.paretovariate(0.8))}" for _ in range(300)], ["vilex", "nastor", "Ölgrumbo"]
    rows = []
    for i in range(160):
        toxic = int(rnd.random() < 0.3)
        words = [rnd.choice(plain) for _ in range(rnd.choice([0, 1, 3, 30, 60]))]
        for _ in range(len(words) // 6 if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(bad)
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(words).capitalize(), toxic, i % 5 == 0))
    return rows


def _words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _plain_model(rows, discount):
    """log P_1 - log P_0 of a text, from counts of documents by class."""
    n = [Counter(), Counter()]
    for _, text, y, _ in rows:
        s = ["<", *_words(text), ">"]
        n[y].update(set(zip(s, s[1:])))
    after, context, left = ([Counter(), Counter()] for _ in range(3))
    for c in (0, 1):
        for (v, w), k in n[c].items():
            after[c][w] += 1
            context[c][v] += k
            left[c][v] += min(k, discount[c])
    both = Counter(w for _, w in set(n[0]) | set(n[1]))
    return n, after, context, left, both


def _difference(model, types, discount, text):
    n, after, context, left, both = model
    s, out = ["<", *_words(text), ">"], 0.0
    for v, w in zip(s, s[1:]):
        logs = []
        for c in (0, 1):
            size = sum(after[c].values())
            freed = sum(min(k, discount[c]) for k in after[c].values()) / size
            p = max(after[c][w] - discount[c], 0) / size + freed * (both[w] + 1) / (sum(both.values()) + types + 1)
            if context[c][v]:
                p = (max(n[c][v, w] - discount[c], 0) + left[c][v] * p) / context[c][v]
            logs.append(math.log(p))
        out += logs[1] - logs[0]
    return out


@pytest.mark.parametrize("hot", [0, 40, 1 << 19])
def test_differences_equal_plain_kneser_ney(spark, monkeypatch, hot):
    """Whether an expression's value comes from the broadcast or from the table's parts."""
    monkeypatch.setattr(toxicity, "HOT", hot)
    rows, discount = _corpus(), (2.0, 1.0)
    training = spark.createDataFrame([r[1:] for r in rows], "text string, toxic int, fit boolean").selectExpr("text", "toxic AS label", "fit").repartition(3)
    table, unknown = toxicity._differences(toxicity._gather(training, 5, discount), discount)
    model = toxicity._model(materialize(table, "test-model"), unknown)
    assert len(model.hot[0]) <= hot
    asked = [(r[0], r[1]) for r in rows] + [(900, "vilex unheard words w1 w1 nastor"), (901, ""), (902, None), (903, "vilex " * 500)]
    docs = spark.createDataFrame(asked, "doc_id long, text string").select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(None).cast("int").alias("label"), "text")
    types = len({w for _, t, _, _ in rows for w in _words(t)}) + 1                        # every word and the end
    for which, counted in ((0, rows), (1, [r for r in rows if not r[3]])):
        got = {r.doc_id: r for r in toxicity._sums(docs.repartition(4), model, which, 5).collect()}
        assert len(got) == len(asked)
        plain = _plain_model(counted, discount)
        for d, text in asked:
            assert got[d].words == len(_words(text))
            assert abs(got[d].x - _difference(plain, types, discount, text)) < 1e-3 * (1 + len(_words(text)))


def test_toxic_rows_go_and_others_stay_whole(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [f"w{rnd.randrange(200)}" for _ in range(40)]
        for k in range(5 if bad else 0):
            words[rnd.randrange(40)] = rnd.choice(["vilex", "nastor"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(None, None), (None, rows[0][1]), (1, rows[1][1]), (4, "w1 w2 w3"), (700, "")]
    docs = odd(frame(spark, rows))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    bad = {i for i in range(0, 600, 4)}
    gone = {d for d, _ in rows} - {d for d, _ in left}
    assert gone <= bad and len(gone) >= 0.95 * len(bad)
    assert (4, "w1 w2 w3") in left and left.count((1, rows[1][1])) == 2 and (None, None) in left and (None, rows[0][1]) not in left and (700, "") in left
    assert toxicity.without_toxic(docs, None).count() == len(rows)
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_answers_are_no_more_rows_than_asked():
    rnd = np.random.default_rng(5)
    known = np.sort(rnd.choice(10**6, 400, replace=False)).astype(np.int64)
    x, s = rnd.normal(size=400), np.where(rnd.random(400) < 0.1, rnd.random(400), 0.0)
    entries = pa.table({"part": pa.array(np.zeros(400), pa.int32()), "key": known, "x": x, "s": s}).take(rnd.permutation(400))
    asked, want = [], {}
    for piece in (7, 7 << 32, 8 << 32, 9 << 32):
        doc = np.sort(rnd.integers(0, 60, 900))
        key = np.where(rnd.random(900) < 0.3, rnd.choice(known, 900), -5) if piece != 7 else np.full(900, -5)     # piece 7 hits nothing
        row = E.rows("part", np.zeros(900, np.int64), toxicity._ASK, [key, doc])
        asked.append(pa.Table.from_arrays([pa.array([piece]), *row.columns], names=["piece", *row.schema.names]))
        for k, d in zip(key.tolist(), doc.tolist()):
            at = int(np.searchsorted(known, k))
            if at < len(known) and known[at] == k:
                want.setdefault((piece, d), np.zeros(2))[:] += (x[at], s[at])
    got = toxicity._answer(pa.concat_tables(asked), entries)
    assert got.column("piece").to_pylist() == [7 << 32, 8 << 32, 9 << 32]                 # one a piece, not one a document
    found = {}
    for r in got.to_pylist():
        doc, x_, decides, s_ = (np.frombuffer(r[c], k) for c, k in toxicity._ANSWER.items())
        assert (s_ > 0).all() and len(set(doc)) == len(doc)
        found.update({(r["piece"], int(d)): np.array([v, 0.0]) for d, v in zip(doc, x_)})
        for d, v in zip(decides, s_):
            found[(r["piece"], int(d))][1] = v
    assert found.keys() == want.keys() and all(np.allclose(found[k], want[k]) for k in want)
    assert len(toxicity._answer(pa.concat_tables(asked), entries.slice(0, 0))) == 0
    assert len(toxicity._answer(asked[0].slice(0, 0), entries)) == 0


def test_more_groups_of_counts_are_smaller_and_share_no_more_words(spark):
    """The counts' groups follow the planned parts (16 MB of text a group before), a word's pairs meet in a part of them, and sums stay."""
    parts, rnd = 128, np.random.default_rng(9)
    v, w = rnd.integers(1 << 20, 1 << 47, 50, dtype=np.uint64), rnd.integers(1 << 20, 1 << 47, 1000, dtype=np.uint64)
    v, w = np.repeat(v, 1000), np.tile(w, 50)
    part = toxicity._part(v, w, toxicity._pair_key(v, w), parts)
    assert part.min() >= 0 and part.max() < parts and set(toxicity._part(v, w, v, 5)) <= set(range(toxicity._SIDES ** 2))
    for word in (v, w):
        held = [set(part[word == x]) for x in np.unique(word)]
        assert max(map(len, held)) <= parts // toxicity._SIDES                            # no more partial sums than a fourth as many groups made
    assert np.bincount(part[v == v[0]]).max() < 100                                       # but a common word has no group of its own
    rows, discount = _corpus(), (2.0, 1.0)
    training = spark.createDataFrame([r[1:] for r in rows], "text string, toxic int, fit boolean").selectExpr("text", "toxic AS label", "fit")
    sums = []
    for many in (1, 5, parts):
        got = toxicity._gather(training, many, discount).groupBy("v", "w", "key").agg(*(F.sum(f"a{i}").alias(f"a{i}") for i in range(8)))
        sums.append(sorted(map(tuple, got.collect()), key=repr))
    assert sums[0] == sums[1] == sums[2]


def test_counts_are_grouped_by_all_planned_parts(spark, monkeypatch):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, toxic int")
    asked, gather = [], toxicity._gather
    monkeypatch.setattr(toxicity, "_gather", lambda training, parts, discount: asked.append(parts) or gather(training, parts, discount))
    monkeypatch.setattr(E, "sizes", lambda d: (160, 320))
    assert toxicity.train(docs, labels) is not None and asked == [160]


def test_words_are_hashed_in_small_pieces(texts):
    """Pieces of an eighth hold an eighth of the memory (47 MB for 1 MB of text before) and give the same hashes."""
    buf, bounds = T.joined(pa.array([t for _, t in texts] * 20))
    starts, ends = T.word_spans(buf)
    assert (T.word_hashes(buf, starts, ends) == T.word_hashes(buf, starts, ends, size=1000)).all()
    text = pa.array([" ".join(f"word{i % 7919}" for i in range(100_000))])
    T.release()
    tracemalloc.start()
    toxicity._expressions(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * (1 << 20)
