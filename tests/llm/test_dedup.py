"""Jaccard join, substring and suffix-array dedup against brute force."""

import hashlib
import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from quantlake.llm import exchange, jaccard_join, substring_dedup, suffix_dedup
from quantlake.llm.components import components

from llm_helpers import frame, odd, texts  # noqa: F401  (texts is a fixture)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = np.iinfo(np.int64).max


def _places(rows):
    return sorted(((LAST if d is None else d), t or "") for d, t in rows)


def _removed(units_of, span):
    """{(doc, text): flags} for texts given as sequences, by places (doc, position)."""
    first = {}
    for (d, t), u in units_of.items():
        for p in range(len(u) - span + 1):
            k = tuple(u[p:p + span])
            first[k] = min(first.get(k, (d, p)), (d, p))
    out = {}
    for (d, t), u in units_of.items():
        flags = [False] * len(u)
        for p in range(len(u) - span + 1):
            if first[tuple(u[p:p + span])] < (d, p):
                flags[p:p + span] = [True] * span
        out[d, t] = flags
    return out


def _substring(rows):
    units = {(d, t): WORD.findall(t) for d, t in _places(rows)}
    gone = _removed(units, 20)
    out = []
    for d, t in _places(rows):
        w, g = units[d, t], gone[d, t]
        kept = " ".join(x for x, y in zip(w, g) if not y)
        out.append((None if d == LAST else d, len(w), sum(g), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def _suffix(rows):
    units = {(d, t): t.encode() for d, t in _places(rows)}
    gone = _removed(units, 100)
    out = []
    for d, t in _places(rows):
        w, g = units[d, t], gone[d, t]
        kept = bytes(x for x, y in zip(w, g) if not y)
        spans = len(re.findall("1+", "".join("01"[y] for y in g)))
        out.append((None if d == LAST else d, len(w), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_substring_dedup(spark, texts):
    got = substring_dedup.dedup(odd(frame(spark, texts)).repartition(5)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert _key(got) == _key(_substring(texts))
    assert sum(r[2] for r in got) > 500


def test_suffix_dedup(spark, texts):
    got = suffix_dedup.dedup(odd(frame(spark, texts)).repartition(5)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert _key(got) == _key(_suffix(texts))
    assert sum(r[2] for r in got) > 500


def test_periodic_texts(spark):
    rows = [(1, "ab" * 55), (2, "abc" * 200), (3, "x" * 101), (4, "é" * 60 + "q" + "é" * 60), (5, "z" * 99), (6, "z" * 99), (7, "ab" * 800 + "c")]
    got = suffix_dedup.dedup(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert _key(got) == _key(_suffix(rows))


LINE = "Many documents hold this very line between others, and its seeds are least."


def _around(rnd, n, line=LINE):
    """Texts with a line between others that differ."""
    return ["".join(rnd.choice("abcdefg \n") for _ in range(rnd.randint(0, 140))) + "\n" + (line if i % 5 else "")
            + "\n" + "".join(rnd.choice("hijklm") for _ in range(rnd.randint(0, 140))) for i in range(n)]


@pytest.mark.parametrize("everywhere, most", [(1 << 18, 30_000), (32, 100_000)])
def test_no_group_holds_all_runs_of_a_frequent_line(spark, monkeypatch, everywhere, most):
    """Fails where one part gets every run of a minimizer, over 30,000 bytes here; cut to single suffixes they are more, in all parts."""
    rnd = random.Random(7)
    rows = [(i, t) for i, t in enumerate(_around(rnd, 300))]
    rows += [(400, "x" + rows[1][1] + "y"), (401, rows[2][1]), (401, rows[2][1]), (None, rows[3][1]), (402, "ab" * 300), (403, "a" * 400), (404, None), (405, LINE * 3)]

    def entries(table, cols):
        if "data" in table.column_names and sum(len(x) for x in table.column("data").to_pylist()) > most:
            raise ValueError("a group holds all runs")
        return exchange.entries(table, cols)

    monkeypatch.setattr(suffix_dedup, "X", SimpleNamespace(**{k: v for k, v in vars(exchange).items() if not k.startswith("__")} | {"entries": entries}))
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 16, raising=False)
    monkeypatch.setattr(suffix_dedup, "EVERYWHERE", everywhere, raising=False)
    got = suffix_dedup.dedup(frame(spark, rows).repartition(6)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert _key(got) == _key(_suffix(rows))
    assert sum(r[2] for r in got) > 500


def test_stretches_keep_equal_suffixes_together():
    rnd = random.Random(1)
    texts = [*_around(rnd, 200), *["a" * 700, "ab" * 400, "abc" * 300, "", LINE * 3] * 2]
    s = suffix_dedup.Suffixes(pa.array(texts), 100, 24)
    start, n = s.runs(np.unique(s.hash[s.anchors()]), 256)
    raw = s.buf.tobytes()
    whole = sorted(p for a, m in zip(start.tolist(), n.tolist()) for p in range(a, a + m))
    for limit in (1, 8, 16):
        first, many, key = s.stretches(start, n, np.full(len(start), limit))
        assert many.max() <= limit
        places = [(p, k) for a, m, k in zip(first.tolist(), many.tolist(), key.tolist()) for p in range(a, a + m)]
        assert sorted(p for p, _ in places) == whole
        keys = {}
        assert all(keys.setdefault(raw[p:p + 100], k) == k for p, k in places)
        # the line has 75 bytes, so what its suffixes share has some of its neighbours too
        assert np.bincount(np.unique(key[many > 0], return_inverse=True)[1], weights=many).max() < np.bincount(np.unique(s.least[start], return_inverse=True)[1], weights=n).max() / 4


def test_repeats_in_shares():
    """Whatever the shares, the same suffixes are repeats; the largest sort follows their size."""
    rnd = random.Random(2)
    data = np.frombuffer("\n".join(_around(rnd, 60) * 2).encode(), dtype=np.uint8)
    starts = np.arange(len(data) - 99)
    doc, pos = starts % 7, starts
    raw = data.tobytes()
    first = {}
    for i in starts.tolist():
        first[raw[i:i + 100]] = min(first.get(raw[i:i + 100], (9, 0)), (i % 7, i))
    want = [i for i in starts.tolist() if first[raw[i:i + 100]] < (i % 7, i)]
    assert len(want) > 1000
    for size in (1 << 18, 500):
        assert sorted(suffix_dedup.repeats(data, starts, doc, pos, size=size).tolist()) == want
    assert len(suffix_dedup.repeats(data, starts[:0], doc[:0], pos[:0])) == 0


def test_deep_shallow_order():
    rnd = random.Random(3)
    for _ in range(60):
        data = bytes(rnd.choice(b"ab") if rnd.random() < 0.05 else 97 for _ in range(rnd.randint(150, 500)))
        data += data[20:] + bytes(rnd.choice(b"abc") for _ in range(30))
        starts = np.array(rnd.sample(range(len(data) - 99), 150))
        order, new = suffix_dedup.deep_shallow(np.frombuffer(data, dtype=np.uint8), starts)
        cut = [data[s:s + 100] for s in starts[order]]
        assert cut == sorted(cut)
        assert [bool(x) for x in new] == [i == 0 or cut[i] != cut[i - 1] for i in range(len(cut))]


def _components(rows, k, num, den):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[d] = frozenset(tuple(w[p:p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    comp = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a is not None and b is not None and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and sets[b]:
                    m = min(comp[a], comp[b])
                    changed |= comp[a] != m or comp[b] != m
                    comp[a] = comp[b] = m
    return {(d, len(sets[d]), comp[d]) for d in sets}


def test_jaccard_join(spark, texts):
    rows = [r for r in texts if r[0] is not None]
    for k, num, den in ((3, 9, 10), (5, 4, 5)):
        got = jaccard_join.near_duplicates(odd(frame(spark, rows)).repartition(5), k, num, den).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == _components(rows, k, num, den)


def test_jaccard_groups_of_pairs_are_planned_by_their_sets(spark, monkeypatch):
    """Fails where pairs of long texts share as few groups as those of short ones: 114 pairs of 796 n-grams in 16 groups are 5,600 on the mean."""
    words = [f"w{i}" for i in range(6000)]
    rows = [(10 * i + j, " ".join(words[150 * i:150 * i + 400] + [f"x{i} y{j}"])) for i in range(38) for j in range(4)]

    def entries(table, cols):
        out = exchange.entries(table, cols)
        if list(cols) == ["a", "b", "na", "nb"] and int(out[2].sum() + out[3].sum()) > 5_500:
            raise ValueError("a group holds too many n-grams")
        return out

    monkeypatch.setattr(jaccard_join, "X", SimpleNamespace(**{k: v for k, v in vars(exchange).items() if not k.startswith("__")} | {"entries": entries}))
    monkeypatch.setattr(jaccard_join, "GROUP_GRAMS", 1000, raising=False)
    monkeypatch.setattr(jaccard_join, "HELD_GRAMS", 300, raising=False)
    got = jaccard_join.near_duplicates(frame(spark, rows), 5, 4, 5, links=False).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == _components(rows, 5, 4, 5)


def test_jaccard_chain_of_near_copies(spark):
    """Documents that only link to their neighbours, so no hub sees them all."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i:6 * i + 150])) for i in range(40)]
    got = jaccard_join.near_duplicates(frame(spark, rows), 3, 9, 10).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == _components(rows, 3, 9, 10)


def _links(rows, k, num, den):
    """{doc_id: number of other documents whose set links to its own}, by all pairs."""
    sets = {}
    for d, t in rows:
        w = [x.lower() for x in WORD.findall(t or "")]
        sets[d] = {tuple(w[p:p + k]) for p in range(max(1, len(w) - k + 1))} if w else set()
    return {a: sum(a != b and bool(x and y) and den * len(x & y) >= num * len(x | y) for b, y in sets.items()) for a, x in sets.items()}


def test_jaccard_counts_every_link(spark, monkeypatch):
    """A group of near copies that all link, one whose ends don't, exact copies of some, and texts that link with nothing; in one block and in several."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:100] + [f"x{i}"])) for i in range(30)]
    rows += [(100 + i, " ".join(words[200 + 2 * i:300 + 2 * i])) for i in range(20)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[35][1]), (203, ""), (204, None), (205, "w1 w2 w3 w4")]
    want = _links(rows, 3, 9, 10)
    assert want[0] == 31 and want[203] == 0 and len({want[100 + i] for i in range(20)}) > 2
    for sets in (2048, 7):
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", sets)
        got = jaccard_join.near_duplicates(frame(spark, rows), 3, 9, 10).collect()
        assert {r.doc_id: r.n_links for r in got} == want
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == _components(rows, 3, 9, 10)
    assert "n_links" not in jaccard_join.near_duplicates(frame(spark, rows[:3]), 3, 9, 10, links=False).columns


def test_null_id_and_empty_tables(spark):
    none = frame(spark, [])
    assert jaccard_join.near_duplicates(none).count() == 0
    assert substring_dedup.dedup(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0
    got = jaccard_join.near_duplicates(frame(spark, [(None, "a b c d"), (3, None), (4, "a b c d")]), 3, 9, 10).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(None, 2, 4), (3, 0, 3), (4, 2, 4)}


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
