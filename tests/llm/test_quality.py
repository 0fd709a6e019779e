import random

import numpy as np
import pytest

from tillwise.llm import quality

SF = "/root/testdata/sf0.1"


def test_em_finds_labeller_accuracies():
    rng = random.Random(6)
    rates = [(0.9, 0.03), (0.7, 0.05), (0.8, 0.01)]  # says "bad" on bad, on good
    counts, truth = {}, {}
    for _ in range(20_000):
        bad = rng.random() < 0.2
        pattern = tuple(0 if rng.random() < 0.2 else 2 if rng.random() < r[not bad] else 1 for r in rates)
        counts[pattern] = counts.get(pattern, 0) + 1
        t = truth.setdefault(pattern, [0, 0])
        t[bad] += 1
    found = quality.label_em(counts)
    for p, n in counts.items():
        if n > 300:
            assert abs(found[p] - truth[p][1] / n) < 0.12
    assert quality.label_em({}) == {}


def test_ftrl_learns():
    rng = np.random.default_rng(1)
    model = quality.Ftrl()
    for _ in range(2000):
        bad = rng.random() < 0.5
        model.learn(*np.unique(np.append(rng.integers(10, 500, 30), 3 if bad else 4), return_counts=True), float(bad))
    w = model.weights()
    assert w[3] > 1 and w[4] < -1


@pytest.fixture(scope="module")
def held_out(spark):
    """Fitted with half of the labels; judged on the other half."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.pmod(F.hash("doc_id"), F.lit(2)) == 0
    model = quality.fit(docs, labels.where(half))
    scored = quality.classify(docs, model).join(labels.where(~half), "doc_id").collect()
    return docs, labels, scored


def test_held_out_accuracy(held_out):
    _, _, rows = held_out
    bad = [r for r in rows if r["quality"] == 0]
    insulted = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(not r["kept"] for r in bad) >= 0.97 * len(bad)
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)
    assert sum(not r["kept"] for r in insulted) >= 0.75 * len(insulted)


def test_odd_inputs(spark, docs, clashing, empty_docs):
    labels = spark.createDataFrame([(10, 1, 0), (11, 0, 1), (None, 1, 1), (12, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit(clashing, labels)
    rows = quality.classify(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and 0 <= r["weak_label"] <= 1 for r in rows)
    kept = quality.keep_good(clashing, model)
    assert kept.columns == clashing.columns and kept.count() == sum(r["kept"] for r in rows)
    twice = [r["score"] for r in rows if r["doc_id"] == 3]
    assert twice[0] == twice[1]
    empty = quality.fit(empty_docs, labels.limit(0))
    assert quality.classify(empty_docs, empty).count() == 0 == quality.keep_good(empty_docs, empty).count()
