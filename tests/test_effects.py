"""Uplift tree against a plain recursion, synthetic control against planted effects."""

import random

import numpy as np
import pytest

from tillwise.operators.counterfactual import nearest_mix, synthetic_control
from tillwise.operators.uplift import fit_uplift_tree, score_uplift

UPLIFT = "a long, b long, y int, t boolean"


def _rates(rows):
    t, c = [r for r in rows if r[3]], [r for r in rows if not r[3]]
    return len(t), len(c), sum(r[2] for r in t) / len(t) - sum(r[2] for r in c) / len(c) if t and c else None


def _grow(rows, depth, least, node=1):
    out = {node: (None, *_rates(rows))}
    best = None
    for f, name in enumerate("ab"):
        for cut in sorted({r[f] for r in rows if r[f] is not None}):
            left = [r for r in rows if r[f] is not None and r[f] <= cut]
            right = [r for r in rows if r[f] is None or r[f] > cut]
            if min(*_rates(left)[:2], *_rates(right)[:2]) < least:
                continue
            d, dl, dr = _rates(rows)[2], _rates(left)[2], _rates(right)[2]
            gain = len(left) / len(rows) * dl * dl + len(right) / len(rows) * dr * dr - d * d
            if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                best = gain, name, cut, left, right
    if depth and best:
        out[node] = (best[1:3], *_rates(rows))
        out |= _grow(best[3], depth - 1, least, 2 * node) | _grow(best[4], depth - 1, least, 2 * node + 1)
    return out


def test_uplift_tree_equals_a_plain_recursion(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        a, b, t = rng.choice([0, 1, 2, 3, 4, None]), rng.randrange(3), rng.random() < 0.5
        lift = 0.4 if t and a is not None and a <= 1 else 0.15 if t and b == 2 else 0.0
        rows.append((a, b, int(rng.random() < 0.2 + lift), t))
    odd = rows + [(1, 1, None, True), (1, 1, 1, None)]  # without outcome or arm: no part
    df = spark.createDataFrame(odd, UPLIFT)
    nodes, splits = fit_uplift_tree(df, ["a", "b"], "y", "t", depth=3, min_arm=30)
    want = _grow(rows, 3, 30)
    got = {r.node: ((r.feature, r.last_bin) if r.feature else None, r.n_treat, r.n_ctrl, r.uplift) for r in nodes.collect()}
    assert {n: v[:3] for n, v in got.items()} == {n: v[:3] for n, v in want.items()}
    assert all(abs(got[n][3] - want[n][3]) < 1e-12 for n in got)
    assert splits[1] == ("a", 1)
    scored = score_uplift(df, nodes, splits)
    assert scored.count() == len(odd) and scored.where("uplift is null").isEmpty()
    assert scored.where("a <= 1").agg({"uplift": "min"}).first()[0] > 0.3


def test_uplift_tree_of_few_rows(spark):
    nodes, splits = fit_uplift_tree(spark.createDataFrame([], UPLIFT), ["a", "b"], "y", "t")
    assert nodes.isEmpty() and not splits
    nodes, splits = fit_uplift_tree(spark.createDataFrame([(1, 1, 1, True)] * 5, UPLIFT), ["a", "b"], "y", "t", min_arm=1)
    assert [(r.node, r.n_treat, r.n_ctrl, r.uplift) for r in nodes.collect()] == [(1, 5, 0, None)] and not splits


def test_nearest_mix_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x = rng.normal(size=(rng.integers(2, 6), rng.integers(2, 9)))
        y = rng.normal(size=len(x))
        d = x - y[:, None]
        w = nearest_mix(d.T @ d)
        assert (w >= 0).all() and abs(w.sum() - 1) < 1e-9
        slope = d.T @ (d @ w)  # no move towards any single unit comes nearer
        assert slope.min() >= slope @ w - 1e-8


def test_synthetic_control_finds_a_planted_effect(spark):
    rng = np.random.default_rng(7)
    base = {f"u{k}": 100 + np.cumsum(rng.normal(size=40)) * 3 for k in range(8)}
    mix = 0.6 * base["u1"] + 0.4 * base["u5"]
    base["me"] = mix + np.where(np.arange(40) >= 30, 50.0, 0.0)
    rows = [(u, i, float(v) / 2) for u, s in base.items() for i, v in enumerate(s) for _ in range(2)]  # two rows a period
    rows += [(None, 3, 9.0), ("u1", None, 9.0), ("u2", 3, None)]
    df = spark.createDataFrame(rows, "unit string, day int, sales double")
    effects, units = synthetic_control(df, "unit", "day", "sales", "me", 30)
    got = {r.period: r for r in effects.collect()}
    assert len(got) == 40
    assert all(abs(r.effect - (50 if d >= 30 else 0)) < 1e-6 and r.is_post == (d >= 30) for d, r in got.items())
    assert all(r.low <= r.high for r in got.values())
    w = {r.unit: r for r in units.collect()}
    assert abs(w["u1"].weight - 0.6) < 1e-9 and abs(w["u5"].weight - 0.4) < 1e-9
    assert abs(sum(r.weight for r in w.values()) - 1) < 1e-9
    assert abs(w["me"].p_value - 1 / 9) < 1e-12  # the largest ratio of all nine
    for bad in ({"treated": "nobody"}, {"start": 0}, {"max_units": 3}):
        with pytest.raises(ValueError):
            synthetic_control(**{"df": df, "unit": "unit", "period": "day", "value": "sales", "treated": "me", "start": 30} | bad)
