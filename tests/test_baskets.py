import random
from collections import Counter
from itertools import combinations

import pytest

from tillwise.operators import baskets


def carts(seed=2):
    rng = random.Random(seed)
    rows = [(None, 1), (1, None), (None, None), (2, 7), (3, 7), (3, 7), (3, 8), (3, 8)]
    for b in range(10, 150):
        items = {1, *(rng.randrange(1, 40) for _ in range(rng.randrange(1, 6)))}  # item 1 is in every basket
        rows += [(b, i - 20) for i in items for _ in range(rng.randrange(1, 3))]
    rows += [(500, i) for i in range(-30, 90)]  # one heavy basket
    return rows


def pairs_of(rows):
    held = {}
    for b, i in rows:
        if b is not None and i is not None:
            held.setdefault(b, set()).add(i)
    return held, Counter(p for items in held.values() for p in combinations(sorted(items), 2))


@pytest.mark.parametrize("sizes", [dict(block=8, lists=5), dict(block=50, lists=20), {}])
def test_pairs_and_ranks_against_brute_force(spark, sizes):
    rows = carts()
    df = spark.createDataFrame(rows, "cart long, sku long").repartition(5)
    held, pairs = pairs_of(rows)
    got = {(r.a, r.b): r.n for r in baskets.pair_counts(df, "cart", "sku", **sizes).collect()}
    assert got == pairs
    single = Counter(i for items in held.values() for i in items)
    want = set()
    for i in single:
        ranked = sorted((-n * float(len(held)) / (single[i] * single[o]), -n, o) for p, n in pairs.items() if i in p and n >= 2 for o in p if o != i)[:3]
        want |= {(i, k + 1, o, -n, round(-x, 9)) for k, (x, n, o) in enumerate(ranked)}
    ranked = baskets.cart_ranking(df, "cart", "sku", top=3, least=2, **sizes).collect()
    assert {(r.item, r["rank"], r.other, r.n_both, round(r.lift, 9)) for r in ranked} == want and len(ranked) == len(want)


def test_a_heavy_basket_leaves_one_row_for_two_blocks(spark):
    df = spark.createDataFrame([(1, i) for i in range(400)], "cart long, sku long").repartition(3)
    assert baskets.pair_counts(df, "cart", "sku", block=50).count() == 400 * 399 // 2


def test_empty(spark):
    df = spark.createDataFrame([], "cart long, sku long")
    assert baskets.cart_ranking(df, "cart", "sku").count() == 0


@pytest.mark.parametrize("small", [1, 3, 500])
def test_small_and_large_baskets_add_up(spark, small):
    df = spark.createDataFrame(carts(), "cart long, sku long").repartition(5)
    got = {(r.a, r.b): r.n for r in baskets.pair_counts(df, "cart", "sku", block=8, small=small).collect()}
    assert got == pairs_of(carts())[1]


def test_small_baskets_make_no_cells(spark, monkeypatch):
    # two baskets an item, and as many blocks as items: nearly each pair would be a cell of its own
    rows = [(b, i) for b in range(200) for i in (b, (b + 1) % 200, (b * 7 + 3) % 200)]
    df = spark.createDataFrame(rows, "cart long, sku long")
    monkeypatch.setattr(baskets, "_block_counts", lambda *_: pytest.fail("a cell for small baskets"), raising=False)
    monkeypatch.setattr(baskets, "_add", lambda *_: pytest.fail("a cell for small baskets"))
    assert {(r.a, r.b): r.n for r in baskets.pair_counts(df, "cart", "sku", block=1).collect()} == pairs_of(rows)[1]
