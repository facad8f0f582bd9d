"""Every stage against a plain version on its own input, and the whole run."""

import re
from collections import defaultdict

import corpus_pipeline as C
import pytest
from llm_helpers import frame, odd, texts  # noqa: F401  (texts is a fixture)
from pyspark.sql import functions as F

from quantlake.llm import jaccard_join


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    rows = [r for r in texts if r[0] is None or r[0] < 300 or r[0] in (300, 301, 304)]
    bad = " vilex nastor grumbo"
    labels = []
    for i in range(500, 900):
        words = " ".join(f"w{(i * 7 + k * k) % 311}" for k in range(40))
        toxic = i % 3 == 0
        rows.append((i, words + (bad if toxic else "") + (" token=aB3dE5fG7hI9jK1l" if i == 502 else "")))
        labels.append((i, 1, int(toxic)))
    path = str(tmp_path_factory.mktemp("pipeline"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _rows(df):
    return {(r.doc_id, r.text) for r in df.collect()}


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def test_stages_and_run(spark, folder):
    docs = odd(spark.read.parquet(f"{folder}/documents.parquet"))
    columns = docs.columns

    kept = C.drop_toxic(spark, docs, folder).cache()
    assert kept.columns == columns
    gone = {r[0] for r in docs.select("doc_id").subtract(kept.select("doc_id")).collect()}
    toxic = {i for i in range(500, 900) if i % 3 == 0}
    assert len(gone & toxic) > 0.95 * len(toxic) and not gone - toxic

    one = C.one_of_near_duplicates(spark, kept, folder).cache()
    assert one.columns == columns
    sets = {r.doc_id: _shingles(r.text) for r in kept.collect() if r.doc_id is not None}
    comp = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and comp[a] != comp[b] and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    ids = [r.doc_id for r in one.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(d for d in sets if comp[d] == d) and len(ids) < len(sets)

    cut = C.cut_repeats(spark, one, folder).cache()
    assert cut.columns == columns and cut.count() == one.count()
    texts = sorted(((r.doc_id if r.doc_id is not None else 2**62), (r.text or "").encode()) for r in one.collect())
    first, want = {}, {}
    for d, t in texts:
        flags = bytearray(len(t))
        for p in range(len(t) - 99):
            if first.setdefault(t[p:p + 100], (d, p)) < (d, p):
                flags[p:p + 100] = b"\1" * 100
        want[d] = bytes(x for x, f in zip(t, flags) if not f).decode("utf-8", "ignore")
    assert {(r.doc_id if r.doc_id is not None else 2**62): r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.where("n_chars IS NOT NULL").collect())

    masked = C.mask_secrets(spark, cut, folder).cache()
    assert masked.columns == columns and masked.count() == cut.count()
    assert "[SECRET]" in masked.where("doc_id = 502").first().text and "aB3dE5fG7hI9" not in masked.where("doc_id = 502").first().text
    assert _rows(masked.where(~F.col("text").contains("[SECRET]"))) <= _rows(cut)

    pieces = C.pack(spark, masked, folder)
    total = defaultdict(int)
    for r in pieces.collect():
        total[r.doc_id] += r.length
    assert set(total) == {r.doc_id for r in masked.collect()}

    run = C.run(spark, folder)
    assert set(run.columns) == set(pieces.columns) and run.count() >= len(total)
    assert [n for n, _ in C.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "secret_scans", "packing"]


def test_empty_documents(spark, tmp_path):
    path = str(tmp_path)
    frame(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert C.run(spark, path).count() == 0


def test_repeated_id_keeps_the_judged_row(spark):
    """Of an id's different texts, the one that was compared with the others stays, however the rows are dealt out."""
    word = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(i, word(2 * i + j), "en", f"s{j}") for i in range(8) for j in range(2)] + [(20, "", "en", "s0"), (20, word(99), "en", "s1")]
    docs = frame(spark, rows)
    copies = {100 + k: r for k, r in enumerate(rows) if r[1]}
    found = jaccard_join.near_duplicates(frame(spark, rows + [(c, r[1]) for c, r in copies.items()]), 5, 4, 5, links=False).collect()
    judged = {r.component_id: copies[r.doc_id][1] for r in found if r.doc_id in copies and r.component_id < 100}
    assert len(judged) == 9
    for order in (rows, rows[::-1]):
        got = C.one_of_near_duplicates(spark, frame(spark, order).coalesce(1), "")
        assert got.columns == docs.columns
        assert {r.doc_id: r.text for r in got.collect()} == judged and got.count() == 9
