"""Learning queries against structure planted in small inputs."""

import time

import numpy as np
import pytest

from tillwise.operators import learning as ml
from tillwise.operators import modeling as md


@pytest.mark.parametrize("keys", ["ints", "longs", "strings"])
def test_items_bought_together_get_near_vectors(spark, keys):
    rng = np.random.default_rng(4)
    name = {"ints": int, "longs": lambda i: int(i) + 10 ** 12, "strings": lambda i: f"i{i:02d}"}[keys]
    rows = [(name(b), name(i)) for b in range(120) for i in rng.choice(6, size=4, replace=False) + 6 * (b % 2)]
    kind = "string" if keys == "strings" else "long"
    df = spark.createDataFrame(rows + [(None, rows[0][1]), (rows[0][0], None)], f"basket {kind}, item {kind}")
    got = {r["item"]: np.array(r["vector"]) for r in ml.basket_embeddings(df, "basket", "item", dim=2).collect()}
    assert set(got) == {str(name(i)) for i in range(12)}
    unit = {k: v / np.linalg.norm(v) for k, v in got.items()}
    group = {str(name(i)): i // 6 for i in range(12)}
    same = [unit[a] @ unit[b] for a in unit for b in unit if a < b and group[a] == group[b]]
    other = [unit[a] @ unit[b] for a in unit for b in unit if a < b and group[a] != group[b]]
    assert np.mean(same) > 0.9 and np.mean(other) < 0.3  # as many factors as planted groups


def test_kmeans_and_tree_find_planted_structure(spark):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0, 9], [9, 0, 0], [0, 9, 0]])
    rows = [(k, (centres[k % 3] + rng.normal(size=3) * 0.3).tolist()) for k in range(90)]
    out = ml.kmeans_segments(spark.createDataFrame(rows, "id int, v array<double>"), "v", k=3).collect()
    assert len({r["cluster"] for r in out}) == 3
    assert all(len({r["cluster"] for r in out if r["id"] % 3 == k}) == 1 for k in range(3))
    steps = [(float(a), float(b), (10.0 if a > 4 else 0.0) + (3.0 if b > 2 else 0.0)) for a in range(10) for b in range(6)]
    scored = ml.tree_scoring(spark.createDataFrame(steps, "a double, b double, y double"), ["a", "b"], "y").collect()
    assert all(abs(r["prediction"] - r["y"]) < 1e-9 for r in scored)


def test_text_classifier_on_held_out_documents(spark):
    rng = np.random.default_rng(6)
    words = [["fine", "solid", "clear"], ["junk", "spam", "noise"]]
    docs = [(k, " ".join(rng.choice(words[k % 2], size=6).tolist() + rng.choice(["the", "a", "of"], size=6).tolist())) for k in range(80)]
    docs += [(80, None), (81, "")]
    labels = [(k, 1 - k % 2) for k in range(50)]  # the other documents are held out
    _, scored = ml.text_classifier(spark.createDataFrame(docs, "doc_id int, text string"),
                                   spark.createDataFrame(labels, "doc_id int, quality int"), num_features=1 << 12)
    got = {r["doc_id"]: r["prediction"] for r in scored.collect()}
    assert len(got) == 82 and all(got[k] == 1 - k % 2 for k in range(80))


def test_cross_validation_reports_every_fold(spark):
    rows = [(p, w, float(w % 4), float(2 * (w % 4) + p)) for p in range(4) for w in range(24)]
    df = spark.createDataFrame(rows, "product int, week int, x double, y double")
    report = md.cv_report(df, ["x", "product"], "y", "week", n_splits=3, max_iter=8, step=0.5, depth=3, min_leaf=1).collect()
    assert sorted(r["fold"] for r in report) == [0, 1, 2] or sorted(r["fold"] for r in report) == [1, 2, 3]
    assert all(np.isfinite(r["wape"]) and r["wape"] < 0.3 for r in report)


def test_rounds_of_the_embeddings_give_back_what_they_sent(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS
    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data: seen.append((self, data)) or fit(self, data))
    rng = np.random.default_rng(2)
    rows = [(int(b), int(i)) for b, i in zip(rng.integers(0, 60, 400), rng.integers(0, 12, 400))]
    got = {r["item"]: r["vector"] for r in ml.basket_embeddings(spark.createDataFrame(rows, "basket long, item long"),
                                                                "basket", "item", dim=3).collect()}
    (als, data), = seen
    # shuffles of a round go with its checkpoint; the last factors of the baskets, which nobody reads, are not made
    assert als.getCheckpointInterval() == 1 and als.getFinalStorageLevel() == "NONE"
    plain = fit(als.copy({als.checkpointInterval: -1, als.finalStorageLevel: "MEMORY_AND_DISK"}), data)
    assert got == {str(r["id"]): r["features"] for r in plain.itemFactors.collect()}


def test_the_driver_looks_for_unused_shuffles_during_a_long_job():
    from types import SimpleNamespace as Part

    from tillwise.session import unused_shuffles_removed
    looks = []
    jvm = Part(System=Part(gc=lambda: looks.append(1)))
    with unused_shuffles_removed(Part(sparkContext=Part(_jvm=jvm)), every=0.01):
        time.sleep(0.5)
    seen = len(looks)
    time.sleep(0.1)
    assert 0 < seen == len(looks)
