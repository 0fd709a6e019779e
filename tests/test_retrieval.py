"""Retrieval against a plain twin, and what comes together in a task."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tillwise.operators import text as tx

WORDS = ["the", "of", *(f"w{i}" for i in range(30))]


def corpus():
    rng = random.Random(3)
    docs = [(i, " ".join(["the", *rng.choices(WORDS, k=rng.randrange(0, 12))])) for i in range(150)]
    docs += [(300 + i, "the same w1 text") for i in range(40)]  # ties go by document
    docs += [(7, docs[7][1]), (None, "w3 w3 the"), (400, None), (401, ""), (402, "Nothing else")]
    asks = [(i, "the " + " ".join(rng.choices(WORDS, k=5))) for i in range(25)]
    asks += [(3, "w1 w2"), (None, "w3"), (30, None), (31, ""), (32, "unheard"), (33, "same")]
    return docs, asks


def split(t):
    return [w for w in re.split(r"[^0-9a-z]+", (t or "").lower()) if w]


def twin(docs, asks, k):
    tf, dl = Counter(), {}
    for d, t in docs:
        for w in split(t):
            tf[d, w] += 1
            dl[d] = len(split(t))
    df = Counter(w for _, w in tf)
    sizes = [len(split(t)) for _, t in docs if t is not None]
    avg, n = sum(sizes) / len(sizes), len(docs)
    score = defaultdict(float)
    for q, t in asks:
        for w in dict.fromkeys(split(t)):
            for (d, x), c in tf.items():
                if x == w:
                    score[q, d] += math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * dl[d] / avg))
    out = set()
    for q in {q for q, _ in score}:
        ranked = sorted((-round(s, 6), -1 if d is None else d) for (p, d), s in score.items() if p == q)[:k]
        out |= {(q, None if d == -1 else d, round(-s, 5), r + 1) for r, (s, d) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("sizes", [dict(block=40, chunk=4), {}])
def test_topk_against_a_plain_twin(spark, sizes):
    docs, asks = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(asks, "item long, text string")
    got = tx.retrieve_topk(d, q, "item", 6, **sizes)
    assert got.columns == ["item", "doc_id", "score", "rank"]
    assert {(r["item"], r["doc_id"], round(r["score"], 5), r["rank"]) for r in got.collect()} == twin(docs, asks, 6)


def test_empty_tables(spark):
    docs, asks = corpus()
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asks, "item long, text string")
    assert tx.retrieve_topk(d.limit(0), q, "item").count() == 0
    assert tx.retrieve_topk(d, q.limit(0), "item").count() == 0


def test_a_word_of_all_documents_meets_the_queries_in_many_cells(spark, monkeypatch):
    """Joined by word, one task would hold every pair of a document and a query."""
    d = spark.range(3000).selectExpr("id as doc_id", "concat('the x', id % 7) as text")
    q = spark.range(50).selectExpr("id as item", "concat('the x', id % 9) as text")
    seen, top = [], tx.top_k_per_group
    monkeypatch.setattr(tx, "top_k_per_group", lambda df, *a, **kw: seen.append(df.count()) or top(df, *a, **kw))
    assert tx.retrieve_topk(d, q, "item", 2, block=1000).count() == 100
    assert seen[0] <= 50 * 2 * 6  # not the 150,000 scores; of each cell the best of each query


def test_best_of_a_cell_by_document_among_ties():
    n = 5000
    asks = {"query": [0, 1, 2], "word": [0, 0, 1], "weight": [1.0, 2.0, 1.0], "doc": [None] * 3, "part": [None] * 3}
    docs = {"query": [None] * n, "word": [0] * n, "weight": [None] * n, "doc": list(range(n)), "part": [1.0 + (i % 3 == 0) for i in range(n)]}
    kinds = {"query": pa.int64(), "word": pa.int64(), "weight": pa.float64(), "doc": pa.int64(), "part": pa.float64()}
    found = tx._best(pa.table({c: pa.array(asks[c] + docs[c], t) for c, t in kinds.items()}), 3).to_pylist()
    assert {(r["query"], r["doc"], r["score"]) for r in found if r["doc"] < 9} == {(q, d, 2.0 + 2 * q) for q in (0, 1) for d in (0, 3, 6)}
    assert all(r["query"] != 2 for r in found)


def test_texts_of_documents_are_not_sorted_to_meet_the_best(spark, capsys, monkeypatch):
    docs = spark.createDataFrame([(1, "one two"), (2, "two"), (2, "again two"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "two"), (8, "one two"), (9, None)], "item_id long, text string")
    best = spark.createDataFrame([(7, 1, 1.0, 1), (7, 2, 0.5, 2), (8, 1, 2.0, 1), (8, 3, 1.0, 2)], "item_id long, doc_id long, score double, rank int")
    plans, keep = [], tx.reliable_checkpoint
    monkeypatch.setattr(tx, "reliable_checkpoint", lambda df: (capsys.readouterr(), df.explain(), plans.append(capsys.readouterr().out), keep(df))[-1])
    got = {(r["item_id"], r["doc_id"], r["hit"]) for r in tx.holding(best, docs, items, "item_id").collect()}
    assert got == {(7, 1, 1), (7, 2, 1), (8, 1, 1), (8, 3, None)}
    assert "SortMergeJoin" not in plans[-1]
