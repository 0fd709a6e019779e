import hashlib
import random
from collections import Counter

import pytest

from tillwise.llm import repeats


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = Counter()
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def rows_of(docs, **kw):
    return Counter(tuple(r) for r in repeats.drop_repeats(docs, **kw).collect())


def test_odd_corpus(docs, docs_rows, clashing, empty_docs):
    want = brute([r[:2] for r in docs_rows], 35)
    assert any(n[2] for n in want)
    assert rows_of(docs, window=35) == want
    assert rows_of(clashing, window=35) == want
    assert repeats.drop_repeats(empty_docs, 35).count() == 0


@pytest.mark.parametrize("window,gram,shard", [(35, 8, 4096), (6, 3, 4096), (6, 6, 2), (5, 1, 3)])
def test_random_texts(spark, monkeypatch, window, gram, shard):
    monkeypatch.setattr(repeats, "PIECES_PER_SHARD", shard)
    rng = random.Random(window * gram)
    passages = [" ".join(f"p{rng.randrange(30)}" for _ in range(rng.randrange(3, 3 * window))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(f"{rng.randrange(3000)}x" for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(0, 5))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(200, "same " * 90), (201, "a b " * 50), (None, rows[3][1]), (3, rows[3][1])]
    assert rows_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window=window, gram=gram) == brute(rows, window)


def test_hash_of_stretches():
    import numpy as np
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"x", b"a", b"b"]
    h = repeats.Hashed(words)
    at = np.array([0, 3, 7, 1])
    three = h.stretch(at[:2], at[:2] + 3)
    two = h.stretch(at, at + 2)
    assert three[0] == three[1] and two[0] == two[1] == two[2] != two[3] and three[0] != two[0]


def test_bounds(docs):
    with pytest.raises(ValueError):
        repeats.drop_repeats(docs, 40, 8)


def test_texts_of_one_32_bit_hash_are_told_apart(spark):
    from pyspark.sql import functions as F
    rows = [(None, " ".join(f"{i}w{j}" for j in range(3 + i % 5)) + " " + " ".join(f"{i}q{j}" if i % 2 else f"p{j}" for j in range(40)))
            for i in (34481, 108309, 9214, 283701, 12634, 136651)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert docs.select(F.hash(F.lit(True), "text")).distinct().count() == 3
    assert rows_of(docs, window=35) == brute(rows, 35)


def test_a_hot_anchor_of_many_distinct_pieces(spark, monkeypatch):
    """Every text holds one short common run, so that most windows around it are filed under it, and few repeat."""
    monkeypatch.setattr(repeats, "PIECES_PER_SHARD", 16)
    monkeypatch.setattr(repeats, "GATHERED", 2000)
    monkeypatch.setattr(repeats, "PASSAGES_AT_ONCE", 7)
    rng = random.Random(5)
    rows = [(i, " ".join([f"{rng.randrange(10 ** 6)}" for _ in range(12)] + ["common", "run"] + [f"{rng.randrange(10 ** 6)}" for _ in range(12)])) for i in range(400)]
    rows += [(1000 + i, t.replace(t.split()[0], "other")) for i, t in rows[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, 6)
    assert sum(n[2] > 0 for n in want) == 120
    assert rows_of(docs, window=6, gram=2) == want
