import random
from collections import Counter
from fractions import Fraction

import pytest

from tillwise.llm import mixing


def test_period_deviates_by_less_than_a_block():
    rng = random.Random(3)
    for _ in range(60):
        shares = {f"s{i}": rng.randrange(1, 30) for i in range(rng.randrange(1, 12))}
        period = mixing.pfair_period(shares)
        assert Counter(period) == shares
        assert mixing.deviation(period * 2, shares) < 1


def brute(shares, blocks):
    """Slot by slot, with fractions: earliest deadline among released blocks; fresh windows when a source ends."""
    left, out = {s: n for s, n in blocks.items() if n}, []
    while left:
        total = sum(shares[s] for s in left)
        done, t, live = dict.fromkeys(left, 0), 0, dict(left)
        while all(live.values()):
            ready = [(-(-(done[s] + 1) * total // shares[s]), s) for s in live if done[s] * total // shares[s] <= t]
            s = min(ready)[1]
            out.append((s, blocks[s] - live[s]))
            done[s] += 1
            live[s] -= 1
            t += 1
        left = {s: n for s, n in live.items() if n}
    return out


@pytest.mark.parametrize("block", [1, 3, 8])
def test_positions_against_brute_force(spark, docs, docs_rows, block):
    shares = {"s0": 5, "s1": 2, "s2": 1}
    rows = mixing.mix(docs, shares, block, rows_per_range=8).collect()
    pooled = {"other": 1} | shares
    assert sorted(r["position"] for r in rows) == list(range(len(docs_rows)))
    sizes = Counter(r["mix_source"] for r in rows)
    assert sizes == Counter(r[3] if r[3] in shares else "other" for r in docs_rows)
    want = brute(pooled, {s: -(-n // block) for s, n in sizes.items()})
    got = sorted({(r["slot"], r["mix_source"], r["block"]) for r in rows})
    assert [(s, b) for _, s, b in got] == want and [x[0] for x in got] == list(range(len(want)))
    ordered = sorted(rows, key=lambda r: r["position"])
    assert [r["slot"] for r in ordered] == sorted(r["slot"] for r in rows)


def test_order_columns_and_odd_inputs(docs, clashing, empty_docs):
    out = mixing.mixed(clashing, {"s0": 1}, 4)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    where = {r["doc_id"]: r["position"] for r in mixing.mix(docs, {"s0": 1}, 4).collect()}
    seen = [where[r["doc_id"]] for r in out.select("doc_id").collect() if r["doc_id"] not in (None, 3)]
    assert seen == sorted(seen)
    assert mixing.mix(empty_docs, {"s0": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"s0": 0})


def test_deviation_counts_blocks():
    assert mixing.deviation(["a", "a", "b", "b"], {"a": 1, "b": 1}) == Fraction(1)


def test_a_hot_id_is_split_by_text(spark):
    rows = [(None if k % 3 else k, f"text {k % 700}", "s0" if k % 4 else "s1") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shares = {"s0": 3, "s1": 1}
    plain = mixing.mix(df.drop("text"), shares, 8, rows_per_range=16)
    split = mixing.mix(df, shares, 8, rows_per_range=16, carry=True)
    again = mixing.mix(df.repartition(7), shares, 8, rows_per_range=16, carry=True)
    for out in (plain, split):
        got = out.collect()
        assert sorted(r["position"] for r in got) == list(range(2000))
        sizes = Counter(r["mix_source"] for r in got)
        want = brute({"other": 1} | shares, {s: -(-n // 8) for s, n in sizes.items()})
        assert [(s, b) for _, s, b in sorted({(r["slot"], r["mix_source"], r["block"]) for r in got})] == want
    key = lambda r: (r["position"], r["row"])
    assert sorted(map(key, split.collect()), key=lambda x: x[0]) == sorted(map(key, again.collect()), key=lambda x: x[0])
