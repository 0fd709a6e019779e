import random
import re

import numpy as np
import pytest
import xxhash

from tillwise.functions.components import components
from tillwise.llm import simhash


def brute_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, close):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in close:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_anchors_cover(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        x = rng.getrandbits(64)
        pairs.append((x, x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5)))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "fp long").distinct()
    at = {}
    for r in simhash.at_anchors(rows).collect():
        at.setdefault(r["fp"], set()).add(r["anchor"])
    assert all(len(v) <= 32 for v in at.values())
    assert all(at[signed(x)] & at[signed(y)] for x, y in pairs)


def test_xxhash_is_sparks(spark):
    text = "four words in here"
    assert spark.range(1).selectExpr(f"xxhash64('{text}') h").first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("block", [4096, 3])
def test_against_brute_force(spark, block):
    rng = random.Random(9)
    base = [" ".join(f"W{rng.randrange(5000)}" for _ in range(rng.randrange(1, 400))) for _ in range(50)]
    texts = list(base)
    for t in base:
        for _ in range(3):
            words = t.split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [None, "", " \n", "É é ONE", base[0], base[0].upper()]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, 4, 4, block=block).collect()}
    fps = {i: brute_fingerprint(t, 4) for i, t in rows}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fps
    close = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    assert len(close) > 60
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fps, close)


def test_odd_inputs(spark, docs, clashing, empty_docs):
    one = [tuple(r) for r in simhash.near_duplicates(docs, 4, 4).collect()]
    assert len(one) == docs.count()
    kept = simhash.drop_near_duplicates(clashing, 4, 4)
    assert kept.columns == clashing.columns and kept.select("doc_id").distinct().count() == len({x[2] for x in one})
    assert simhash.near_duplicates(empty_docs, 4, 4).count() == 0
    assert [r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string"), 4, 4).collect()] == [None, None]
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, 4, 6).count()


def test_a_hot_cluster_is_split_and_stays_whole(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(400)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    rows = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(6)
    linked = components(simhash.links(rows, 4, block=16))
    assert linked.count() == len(fps) and linked.select("label").distinct().count() == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    ids = rng.sample(range(10 ** 6), 900)
    edges = list(zip(ids[:500], ids[1:500])) + [(ids[500], x) for x in ids[501:800]] + [(ids[800], ids[801]), (ids[801], ids[800]), (ids[802], ids[802])]
    rng.shuffle(edges)
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(set(got[x] for x in ids[:500])) == 1 and len(set(got[x] for x in ids[500:800])) == 1
    assert got[ids[800]] == got[ids[801]] and ids[802] not in got and len(set(got.values())) == 3


def test_stars():
    fps = np.array([0, 1, 3, 7, 0xFFFF, 0xFFFE], dtype="u8")
    found = simhash.stars(fps, 1)
    assert sorted((int(r), sorted(map(int, o))) for r, o in found) == [(0, [1, 3, 7]), (0xFFFF, [0xFFFE])]


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(4)
    texts = [" ".join(f"t{i}w{rng.randrange(10 ** 6)}" for _ in range(400)) for i in range(5)]
    near = texts[0].upper()
    rows = [(None, texts[0]), (None, texts[0]), (None, near), (3, texts[1]), (3, texts[1]), (2, texts[2]), (3, texts[2]), (None, texts[2]),
            (None, texts[3]), (9, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r["doc_id"], r["text"].lower()) for r in simhash.drop_near_duplicates(docs, 4, 4).collect()]
    assert sorted(got, key=str) == sorted([(None, texts[0]), (3, texts[1]), (2, texts[2]), (None, texts[3]), (9, texts[4])], key=str)
