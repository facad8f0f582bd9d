"""Frames and documents for the tests of this folder."""

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """A documents frame of (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def odd(df):
    """The frame with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    for c in ("part", "bucket", "row", "spans", "score", "h", "node", "value", "hash", "count", "sequence_id"):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def texts():
    """Random short documents with copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rnd = random.Random(5)
    words = [a + b for a in ("th", "er", "Ön", "st", "日", "a") for b in ("in", "ed", "é", "", "x.", "ou")]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows = []
    for i in range(60):
        n = rnd.choice([0, 1, 2, 19, 20, 21, 60, 120, 300])
        t = [rnd.choice(words) for _ in range(n)]
        if rnd.random() < 0.4:
            t[len(t) // 2:len(t) // 2] = passage.split()
        rows.append((i, rnd.choice([" ", " ", "\n", "\t "]).join(t)))
    base = rows[-1][1] + " " + passage
    rows += [(100 + i, base) for i in range(12)]
    for i in range(12):
        t = (passage + " " + base).split(" ")
        t[rnd.randrange(len(t))] = f"neu{i}"
        rows.append((200 + i, " ".join(t)))
    rows += [(300, None), (301, ""), (302, "   \n "), (303, "a" * 5000), (304, "ab " * 3000), (305, "x" * 40 + passage), (303, "a" * 5000),
             (None, passage), (400, "Wort wort WORT ÄÖ"), (401, "wort WORT wort äö")]
    return rows
