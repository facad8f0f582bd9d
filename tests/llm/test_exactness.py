"""Patterned long words and lines, and scores beyond what a float holds."""

import numpy as np
from llm_helpers import frame

from quantlake.llm import jaccard_join, queries, quality_rules, substring_dedup, textops, topk

A = "a"
while len(A) < 4096:
    A += A.translate(str.maketrans("ab", "ba"))
B = A.translate(str.maketrans("ab", "ba"))


def test_complementary_thue_morse_words_hash_apart():
    import pyarrow as pa
    for n in (512, 1024, 2048, 4096):
        buf, bounds = textops.joined(pa.array([A[:n], B[:n], A[:n]]))
        starts, ends = textops.word_spans(buf)
        for which in (0, 1):
            x, y, z = textops.word_hashes(buf, starts, ends, which).tolist()
            assert x != y and x == z


def test_patterned_words_and_lines_stay_apart_in_the_operators(spark):
    queries.ship(spark)
    docs = frame(spark, [(1, A), (2, B), (3, " ".join([A] * 21)), (4, " ".join([B] * 21))])
    near = {r.doc_id: r for r in jaccard_join.near_duplicates(docs, k=3, num=9, den=10).collect()}
    assert [near[i].component_id for i in (1, 2, 3, 4)] == [1, 2, 3, 4] and all(r.n_links == 0 and r.n_copies == 1 for r in near.values())
    cut = {r.doc_id: r.n_removed for r in substring_dedup.dedup(docs).collect()}
    assert cut[1] == cut[2] == 0 and cut[3] == cut[4]
    # lines of many short words that follow the same pattern
    line, other = (" ".join("ab" if c == "a" else "cd" for c in t[:2048]) for t in (A, B))
    found = {r.doc_id: r for r in quality_rules.quality(frame(spark, [(1, f"{line}\n{other}"), (2, f"{line}\n{line}")])).collect()}
    assert found[1].n_dup_lines == 0 and found[2].n_dup_lines == 1


def test_scores_and_order_beyond_a_float():
    base = np.array([[256_000_000, 256_000_000], [256_000_000, 256_000_001], [256_000_001, 256_000_000], [-256_000_000, 3]], dtype=np.int64)
    q = np.array([[256_000_003, 256_000_004]], dtype=np.int64)
    r, c, s = topk.ImpactIndex(base).search(q, np.array([-1]), np.arange(4), 3)
    want = sorted(((-int(a) * int(q[0, 0]) - int(b) * int(q[0, 1]), i) for i, (a, b) in enumerate(base.tolist())))[:3]
    assert list(zip((-s).tolist(), c.tolist())) == want
    rng = np.random.default_rng(3)
    v, q = rng.integers(-2**30, 2**30, (300, 3)), rng.integers(-2**30, 2**30, (20, 3))
    r, c, s = topk.ImpactIndex(v).search(q, np.full(20, -1), np.arange(300), 5)
    for i in range(20):
        exact = [sum(int(a) * int(b) for a, b in zip(x, q[i].tolist())) for x in v.tolist()]
        assert list(zip(s[r == i].tolist(), c[r == i].tolist())) == sorted(((x, j) for j, x in enumerate(exact)), key=lambda t: (-t[0], t[1]))[:5]
