import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, length string, block string, score string, copies string"


def corpus(seed=1, n=260):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0] * 8, 1), (5, None, 1), (10, [nan] + [0.0] * 7, 1), (15, [1.0, None] + [0.0] * 6, 2), (20, [inf] + [1.0] * 7, 1), (25, [1.0] * 8, None),
            (30, [], 1), (31, [], 1), (32, [], 2), (None, [1.0] * 8, 1), (None, [1.0] * 8, 2), (35, [1.0] * 8, 1), (35, [1.0] * 8, 1), (35, [0.5] * 8, 1),
            (40, [1.0] * 3, 1), (41, [0.9] * 3, 1), (42, [0.8] * 3, 2), (45, [-1.0] * 8, 3), (46, [-1.0] * 8, 3)]
    rows += [(50 + i, [0.25] * 8, 1 + i % 2) for i in range(60)]  # one common vector
    for i in range(n):
        c = centres[rng.randrange(6)]
        size = rng.choice([0.2, 1.0, 3.0])
        rows.append((200 + i, [size * (x + rng.gauss(0, 0.3)) for x in c], rng.randrange(4)))
    return [r + ("x",) * 6 for r in rows]


def brute(rows, scale, every, positives, negatives, low, high):
    usable = [(i, tuple(math.floor(float(np.float32(x)) * scale) for x in v), label) for i, v, label, *_ in rows
              if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda s, i: (-s, i is None, i if i is not None else 0)
    out = Counter()
    for n, (a, q, label) in enumerate(usable):
        if a is None or a % every:
            continue
        scores = [(sum(x * y for x, y in zip(q, r)), i, of) for m, (i, r, of) in enumerate(usable) if m != n and len(r) == len(q)]
        near = sorted(((s, i) for s, i, of in scores if of == label), key=lambda x: key(*x))[:positives]
        far = sorted(((s, i) for s, i, of in scores if of != label), key=lambda x: key(*x))
        for p, i in near:
            fits = [x for x in far if low * p <= 100 * x[0] <= high * p][:negatives]
            out.update((a, i, k + 1, j, p, s) for k, (s, j) in enumerate(fits))
    return out


@pytest.mark.parametrize("block, chunk, bounds", [(40, 7, (50, 95)), (10_000, 1000, (50, 95)), (64, 16, (-30, 101))])
def test_equals_brute_force(spark, monkeypatch, block, chunk, bounds):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = hn.hard_negatives(hn.quantised(df, F.col("label"), 256), F.col("id") % 5 == 0, 5, 3, *bounds, block=block, chunk=chunk)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, 256, 5, 5, 3, *bounds)
    assert sum(want.values()) > 100
    assert Counter(map(tuple, got.collect())) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(hn.quantised(df, F.col("label"), 256), F.col("id") % 5 == 0).collect() == []


def test_too_large_components(spark):
    df = spark.createDataFrame([(1, [1e30], 1) + ("x",) * 6], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        hn.quantised(df, F.col("label"), 256).collect()


def test_ranges_lose_no_pair_and_prune():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a = x[:40] + 0.05 * rng.standard_normal((40, 6))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    least = rng.uniform(-1, 1, 40)
    least[:20] = 0.95
    there = hn.feasible(a, x, least)
    assert not ((a @ x.T >= least[:, None]) & ~there).any()
    assert there[:20].mean() < 0.4


def test_exact_products_past_doubles():
    a = np.array([[(1 << 25) + 1, 3]], dtype="i8")
    b = np.array([[(1 << 25) + 3, 5]] * 2, dtype="i8")
    big = np.full((1, 40), (1 << 26) - 1, dtype="i8")
    assert hn._product(a, b).tolist() == [[((1 << 25) + 1) * ((1 << 25) + 3) + 15] * 2]
    assert hn._product(big, big).tolist() == [[40 * ((1 << 26) - 1) ** 2]]
