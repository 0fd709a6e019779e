import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import neighbours as nb

SIZES = dict(block=20, chunk=7, per_pivot=30, most_pivots=9)


def odd_vectors(seed=4, n=300):
    rng = random.Random(seed)
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (5, []), (10, [nan, 1.0, 1.0]), (15, [None, 1.0, 1.0]), (20, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (25, [0.0, 0.0, 0.0]),
            (30, [1.0, 2.0]), (31, [1.0, 2.5]), (35, [7.0] * 5), (40, [2.0, 2.0, 2.0]), (40, [2.0, 2.0, 2.0]), (41, [2.0, 2.0, 2.0])]
    rows += [(1000 + i, [3.0, 3.0, 3.0]) for i in range(120)]  # a hot vector, equally far from all
    rows += [(100 + i, [rng.gauss(0, 1) * (1 + i % 3), rng.gauss(0, 1), rng.choice([0.0, 1.0])]) for i in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [SIZES, {}])
def test_knn_against_brute_force(spark, sizes):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in ("key", "query", "cell", "vec", "rank")}).repartition(4)
    got = nb.knn_topk(df, F.coalesce(F.col("vec_id") % 5 == 0, F.lit(False)), 6, **sizes).collect()
    good = [(i, np.float32(v).astype("f8")) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for i, v in {i: v for i, v in good if i % 5 == 0}.items():
        near = sorted((math.sqrt(((v - w) ** 2).sum()), j) for j, w in good if j != i and len(w) == len(v))[:6]
        want.update((i, k + 1, j, round(d, 9)) for k, (d, j) in enumerate(near))
    assert len(want) > 400
    assert Counter((r.query_id, r["rank"], r.neighbour_id, round(r.distance, 9)) for r in got) == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nb.knn_topk(df, F.lit(True), 3).count() == 0
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert nb.knn_topk(one, F.lit(True), 3).count() == 0
    assert nb.knn_topk(one, F.lit(False), 3).count() == 0


def lof_twin(train, test, k):
    """Plain novelty form over rows; copies are separate rows."""
    x = np.array(train)

    def near(v, leave=None):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        order = [i for i in np.argsort(d, kind="stable") if i != leave][:k]
        return order, d[order]
    own = [near(v, i) for i, v in enumerate(x)]
    kdist = np.array([d[-1] for _, d in own])
    lrd = np.array([1 / (np.maximum(kdist[o], d).mean() + nb.LRD_FLOOR) for o, d in own])
    out = []
    for v in test:
        o, d = near(np.array(v))
        out.append(lrd[o].mean() * (np.maximum(kdist[o], d).mean() + nb.LRD_FLOOR))
    return out


@pytest.mark.parametrize("sizes", [SIZES, {}])
def test_lof_against_numpy(spark, sizes):
    rng = random.Random(1)
    train = [(rng.gauss(0, 1), rng.gauss(0, 2)) for _ in range(250)] + [(5.0, 5.0)] * 40 + [(0.5, 0.25)] * 3
    test = [(rng.gauss(0, 1.5), rng.gauss(0, 2)) for _ in range(60)] + [(5.0, 5.0), (5.0, 5.0), (9.0, 9.0), train[0], (0.5, 0.25)]
    odd = [(None, 1.0), (float("nan"), 1.0), (1.0, float("inf"))]
    a = spark.createDataFrame([(float("nan") if x is None else x, y) for x, y in train + odd], "a double, b double").repartition(3)
    b = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(test)] + [(900 + i, x, y) for i, (x, y) in enumerate(odd)], "id long, a double, b double").repartition(3)
    got = {r.id: r.score for r in nb.lof_scores(a, b, ["a", "b"], k=8, **sizes).collect()}
    want = lof_twin(train, test, 8)
    assert sorted(got) == list(range(len(test)))
    for i, w in enumerate(want):
        assert got[i] == pytest.approx(w, rel=1e-7)
    assert got[62] > 2  # far from all


def test_lof_with_fewer_rows_than_neighbours(spark):
    train = [(0.0, 0.0), (1.0, 0.0), (0.0, 2.0)]
    a = spark.createDataFrame(train, "a double, b double")
    b = spark.createDataFrame([(1, 0.5, 0.5)], "id long, a double, b double")
    got = nb.lof_scores(a, b, ["a", "b"], k=20).first().score
    assert got == pytest.approx(lof_twin(train, [(0.5, 0.5)], 20)[0], rel=1e-7)
    assert nb.lof_scores(a.limit(0), b, ["a", "b"]).count() == 0


@pytest.mark.parametrize("sizes", [SIZES, dict(block=3, chunk=5, per_pivot=4), {}])
def test_boxes_against_brute_force(spark, sizes):
    rng = random.Random(7)
    points = [(i, [float(rng.randint(0, 6)), float(rng.randint(0, 6)), 2.5]) for i in range(200)]  # many equal distances, one constant component
    points += [(1000 + i, [3.0, 3.0, 2.5]) for i in range(50)] + [(2000, [1e9, -1e9, 2.5]), (2001, [1e-9, 0.0, 2.5])]
    queries = points[::7] + [(-1, [50.0, 3.0, 0.0]), (-2, [-1e6, 1e6, 9.0]), (-3, [3.0, 3.0, 2.5])]
    p = spark.createDataFrame([(k, k + 1, v) for k, v in points], "key long, weight long, vec array<double>").repartition(4)
    q = spark.createDataFrame(queries, "query long, vec array<double>").repartition(3)
    got = Counter((r.query, r["rank"], r.key, r.weight, round(r.distance, 9)) for r in nb.nearest_in_boxes(q, p, 6, **sizes).collect())
    want = Counter()
    for i, v in queries:
        near = sorted((math.dist(v, w), j) for j, w in points if j != i)[:6]
        want.update((i, n + 1, j, j + 1, round(d, 9)) for n, (d, j) in enumerate(near))
    assert got == want
    few = nb.nearest_in_boxes(q, p.where("key in (2, 5)"), 6, **sizes).collect()
    assert sorted(r.query for r in few) == sorted([i for i, _ in queries for j in (2, 5) if i != j])
    assert nb.nearest_in_boxes(q, p.limit(0), 6, **sizes).count() == 0
    assert nb.nearest_in_boxes(q.limit(0), p, 6, **sizes).count() == 0


def test_work_of_lof_grows_with_its_rows(spark, monkeypatch):
    """A point meets no more others in a larger table."""
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random(), rng.random()) for i in range(18000)]
    kept, keep = [], nb.reliable_checkpoint

    def spy(df):
        kept.append(keep(df))
        return kept[-1]
    monkeypatch.setattr(nb, "reliable_checkpoint", spy)

    def met(n):
        kept.clear()
        df = spark.createDataFrame(rows[:n], "id long, a double, b double, c double")
        nb.lof_scores(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), ["a", "b", "c"], k=4, block=32, per_pivot=16)
        blocks = [d for d in kept if {"key", "vec", "cell", "shell"} <= set(d.columns)]
        visits = [d for d in kept if {"query", "cell", "shell", "bound"} <= set(d.columns)]
        assert blocks and len(blocks) == len(visits)
        return sum(v.join(b.groupBy("cell", "shell").count(), ["cell", "shell"]).agg(F.sum("count")).first()[0] for b, v in zip(blocks, visits)) / n
    assert met(18000) < 1.5 * met(3000)


def test_fraud_report_takes_the_scores_once(spark, tmp_path, monkeypatch):
    from tillwise.catalog import neighbours as registered
    spark.createDataFrame([(i, i % 90, "P" if i % 7 == 0 else "O", 100.0 + i) for i in range(300)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    made = spark.sparkContext.accumulator(0)

    def scored(i):
        made.add(1)
        return True
    monkeypatch.setattr(registered, "_lof", lambda spark, sf_dir: spark.range(90).where(F.udf(scored, "boolean").asNondeterministic()("id")).select("id", (F.col("id") % 13 + 0.5).alias("score")))
    report = registered.q_fraud_report_lof(spark, str(tmp_path)).collect()
    assert len(report) == 1 and 0 < report[0].roc_auc < 1
    assert made.value == 90
