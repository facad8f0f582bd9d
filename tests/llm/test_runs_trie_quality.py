"""Periodic runs, prefix trie and quality classifier: brute force, held-out accuracy, odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import frame, odd, texts  # noqa: F401  (texts is a fixture)

from quantlake.llm import periodic_runs, prefix_trie, quality_mil, queries

SF0001 = "/root/testdata/sf0.001"


def _lyndon(w):
    out = []
    for i in range(len(w)):
        j = i + 1
        while j < len(w) and w[j:] > w[i:]:
            j += 1
        out.append(j - i)
    return out


def _runs(w, min_length=6, min_exponent=4):
    found = set()
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                x = w[i:j + q]
                if not any(x[r:] == x[:-r] for r in range(1, q)):
                    found.add((i, j + q - i, q))
            i = max(i + 1, j)
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(0, 39), st.integers(1, 6))
def test_lyndon_lengths_and_runs_equal_brute_force(w, a, p):
    if w:
        a %= len(w)
        w = w[:a] + [w[a + (i - a) % p] if a + (i - a) % p < len(w) else w[a] for i in range(a, len(w))]
    ids = np.array(w, dtype=np.int64)
    assert periodic_runs.lyndon_lengths(ids).tolist() == _lyndon(w)
    for rule in ((6, 4), (2, 2)):
        assert [tuple(r) for r in periodic_runs.find_runs(ids, *rule).tolist()] == _runs(w, *rule)


def test_runs_where_the_hash_misleads(monkeypatch):
    """Every stretch looks equal to every other: runs are still exact."""
    monkeypatch.setattr(periodic_runs.T, "span_hashes", lambda v, s, e, which=0: np.zeros(len(s), np.uint64))
    rnd = random.Random(4)
    for _ in range(200):
        w = [rnd.randrange(2) for _ in range(30)]
        got = {tuple(r) for r in periodic_runs.find_runs(np.array(w), 6, 4).tolist()}
        assert got <= set(_runs(w))
    # a whole text of one run
    assert periodic_runs.find_runs(np.array([0, 1, 2] * 5), 6, 4).tolist() == [[0, 15, 3]]


def _row11(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs(w)
    gone = set()
    for s, length, q in runs:
        gone |= set(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_op11_equals_brute_force(spark, texts):  # noqa: F811
    queries.ship(spark)
    more = [(500, "a b " * 5 + "a c c c c c c c"), (501, "x " * 6), (502, "x " * 5), (503, "Ä é " * 4 + "Ä"), (504, " ".join(["p q r"] * 4 + ["p q s"] * 4)),
            (505, " ".join(("u v u v u v u v w " * 5).split()))]
    rows = texts + more
    docs = odd(frame(spark, rows))
    got = periodic_runs.digests(periodic_runs.detect(periodic_runs.with_repeats(docs)))
    assert _sorted(got.collect()) == _sorted(_row11(i, t) for i, t in rows)
    assert periodic_runs.digests(periodic_runs.detect(periodic_runs.with_repeats(frame(spark, [])))).collect() == []


def test_op11_registered_query(spark):
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r[1] or "").split()) <= 400]
    got = {r[0]: tuple(r) for r in queries.op11_periodic_runs(spark, SF0001).collect()}
    assert len(got) == len(rows) and all(got[i] == _row11(i, t) for i, t in short)


def test_runs_long_text_and_structured_words(spark):
    queries.ship(spark)
    # Thue-Morse words and their complements, equal under a polynomial hash modulo 2**64, are different words
    t = "a"
    while len(t) < 2048:
        t += t.translate(str.maketrans("ab", "ba"))
    u = t.translate(str.maketrans("ab", "ba"))
    long = " ".join(["one two three"] * 40000)
    got = {r.doc_id: r for r in periodic_runs.detect(frame(spark, [(1, f"{t} {u} " * 3), (2, f"{t} {u} " * 4), (3, long)])).collect()}
    assert got[1].runs == [] and [tuple(r) for r in got[2].runs] == [(0, 8, 2)]
    assert [tuple(r) for r in got[3].runs] == [(0, 120000, 3)] and got[3].kept_text == "one two three"


def _nodes(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    conv = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda z: z[:2])] for c, v in conv.items()}
    built = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(conv.get(c - c % 100, [])[:h] + v[h:])
    members, below = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        saved[p] = sum(saved[k] for k in below[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(built[c]) == len(p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURNS = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_op12_equals_brute_force(spark, coalesce):
    """One task and many: nodes that several tasks share are finished once."""
    queries.ship(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rnd = random.Random(3)
        rows = []
        for c in rnd.sample(range(0, 500), 220):
            kinds = rnd.choice([1, 1, 2, 3])
            for i in range(rnd.choice([0, 1, 2, 3, 5, 9, 40])):
                rows.append((c, None if i == 0 and rnd.random() < 0.5 else i, rnd.choice(["u", None]) if kinds > 2 else "u", rnd.choice(["a", "日b", None][:kinds])))
        rows += [(7, i, "user", "copy") for i in range(60)] + [(8, i, "user", "copy") for i in range(60)] + [(None, 1, "u", "lost")]
        df = spark.createDataFrame(rows, TURNS)
        assert _sorted(prefix_trie.conversation_trie(odd(df)).collect()) == _sorted(_nodes(rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_op12_digests_of_many_conversations_stream(spark, monkeypatch):
    queries.ship(spark)
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c * 100, 0, "u", "same") for c in range(60)]
    assert _sorted(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()) == _sorted(_nodes(rows))


def test_op12_odd_tables(spark):
    queries.ship(spark)
    for rows in ([], [(None, 0, "u", "x")], [(5, 1, None, None), (5, 1, None, None)], [(5, 0, "u", "a")]):
        assert _sorted(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()) == _sorted(_nodes(rows))


def test_op12_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _sorted(queries.op12_prefix_trie(spark, SF0001).collect()) == _sorted(_nodes(rows))


def test_op13_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    x, n, y = rng.standard_normal((9, quality_mil.WIDTH)), np.array([2, 3, 4]), np.array([0.0, 1.0, 1.0])
    model = quality_mil.Model.fresh(x, 0.6)

    def loss():
        s = model.scores(x, n)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, grad in model.gradient(x, n, y).items():
        at = tuple(rng.integers(0, k) for k in model.parts[name].shape)
        model.parts[name][at] += 1e-6
        up = loss()
        model.parts[name][at] -= 2e-6
        down = loss()
        model.parts[name][at] += 1e-6
        assert abs(grad[at] - (up - down) / 2e-6) < 1e-6


def test_op13_attention_weighs_passages():
    """A document's weights are positive and sum to one; equal passages get equal weights."""
    x, n = quality_mil.encode(pa.array([("good words here " * 60).strip(), "%% ## " * 100, "", None]))
    assert n.tolist() == [3, 4, 1, 1]
    model = quality_mil.Model.fresh(x, 0.5)
    a = model.forward(x, n)[5]
    assert np.allclose(np.add.reduceat(a, np.cumsum(n) - n), 1) and (a > 0).all() and np.isclose(a[3], a[4])


def test_op13_registered_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op13_quality_mil(spark, sf)
    rows = {r.doc_id: r for r in out.collect()}
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "boolean", "double", "int"]
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in rows]
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(rows[r.doc_id].held_out for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert sum(rows[r.doc_id].predicted == r.quality for r in held) / len(held) > 0.9


def test_op13_reads_no_held_out_label_and_takes_odd_rows(spark, texts):  # noqa: F811
    queries.ship(spark)
    docs = odd(frame(spark, texts))
    ids = [r[0] for r in texts if r[0] is not None]
    for rows in ([], [(i, None) for i in ids], [(i, 1) for i in ids], [(i, i % 2) for i in ids] + [(None, 1), (10**9, 0)]):
        labels = odd(spark.createDataFrame(rows, "doc_id long, quality int"))
        got = quality_mil.quality(docs, labels).collect()
        assert len(got) == len(texts) and all(r.score is not None and not np.isnan(r.score) for r in got)
    held = {i for i in ids if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = odd(spark.createDataFrame([(i, 1 - i % 2 if i in held else i % 2) for i in ids], "doc_id long, quality int"))
    again = odd(spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int"))
    assert _sorted(quality_mil.quality(docs, flipped).collect()) == _sorted(quality_mil.quality(docs, again).collect())
    assert quality_mil.quality(frame(spark, []), labels).collect() == []
