import math

import numpy as np
import pytest

from tillwise.llm import embedding_dedup


def brute(rows, least):
    ok = {i: v for i, v in enumerate(rows) if v[1] and all(x is not None and math.isfinite(x) for x in v[1]) and any(v[1])}
    unit = {i: np.array(v[1], dtype="f8") / np.linalg.norm(np.array(v[1], dtype="f8")) for i, v in ok.items()}
    links = {i: set() for i in range(len(rows))}
    for a in unit:
        for b in unit:
            if a < b and unit[a].size == unit[b].size and unit[a] @ unit[b] >= least:
                links[a].add(b)
                links[b].add(a)
    out, seen = [None] * len(rows), set()
    for a in range(len(rows)):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                for b in links[todo.pop()] - group:
                    group.add(b)
                    todo.append(b)
            seen |= group
            ids = [rows[g][0] for g in group if rows[g][0] is not None]
            for g in group:
                out[g] = (rows[g][0], len(links[g]), min(ids) if ids else None)
    return sorted(out, key=repr)


def vectors(rng, n, dim):
    centres = rng.standard_normal((n // 8, dim))
    rows = []
    for k, c in enumerate(centres):
        for _ in range(k % 9 + 1):
            rows.append((c + rng.standard_normal(dim) * rng.choice([0.0, 0.1, 0.25])).tolist())
    return rows


@pytest.mark.parametrize("cell", [512, 4])
def test_recall_and_exact_counts(spark, cell):
    rng = np.random.default_rng(5)
    rows = list(enumerate(vectors(rng, 500, 64)))
    rng.shuffle(rows)
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in rows]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), 0.95, cell=cell).collect()
    want = brute(rows, 0.95)
    mine = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr)
    total = sum(w[1] for w in want)
    assert total > 500 and sum(m[1] for m in mine) >= 0.99 * total
    assert all(m[1] <= w[1] for m, w in zip(mine, want))  # verified: none below the cosine
    if sum(m[1] for m in mine) == total:
        assert mine == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (2, [2.0, 4.0, 6.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]),
            (7, [1.0, None, 3.0]), (8, []), (9, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (None, None), (10, [1e-300, 2e-300, 3e-300]), (11, [1e300, 2e300, 3e300]),
            (12, [-1.0, -2.0, -3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df, 0.95).collect()), key=repr)
    want = {1: (5, 1), 2: (5, 1), 10: (5, 1), 11: (5, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 12: (0, 12)}
    assert len(got) == len(rows)
    for i, n, c in got:
        assert (n, c) == (want[i] if i is not None else (5, 1) if n else (0, None))
    assert embedding_dedup.near_vectors(df.limit(0), 0.95).count() == 0


def test_whole_table_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.6).collect()
    want = {w[0]: w[1] for w in brute(rows, 0.6)}
    assert all(r["n_links"] <= want[r["vec_id"]] for r in got)
