import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillwise.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, k string, phrase string, f string, n string, rank string"


def brute(rows, support, longest, top, share=100):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(upper)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {x: c for x, c in f.items() if c >= support and len(x[1]) > 1}
    out = []
    for (lang, w), a in found.items():
        inside = any(100 * c >= share * a and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
                     for (of, v), c in found.items() if of == lang)
        if not inside:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, score, a, " ".join(w), l, r))
    rows = []
    for lang in n:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))[:top]
        rows += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (_, s, a, p, l, r) in enumerate(best)]
    return sorted(rows)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "É", "ÉA", "x y", "\x00", "a\x1cb", "ﬁ"]
    rows = [(1, None, "en"), (2, "", "en"), (None, "Of The of the OF THE", None), (3, " \t ", "de"), (4, "...!!!", "fr"),
            (5, "of the", "und"), (5, "of the", "und"), (6, "new york city hall " * 3000, "en"), (7, "q" * 200_000 + " of the", None)]
    for i in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            w[5:5] = ["New", "York", "City"]
        text = "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b", "; ", "\r\n"]) for x in w)
        rows.append((i + 10, text, rng.choice(["en", "en", "de", None, "und"])))
    return [r + ("x",) * 5 for r in rows]


@pytest.mark.parametrize("support, longest, top, share, shard", [(8, 5, 40, 100, 20_000), (3, 4, 10_000, 60, 1 << 20), (1, 3, 10_000, 100, 30_000)])
def test_equals_brute_force(spark, support, longest, top, share, shard):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = co.collocations(df, support, longest, top, share, shard_bytes=shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, support, longest, top, share)
    assert len(want) > 10
    assert sorted(map(tuple, got.collect())) == want


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scores_past_64_bits(spark):
    big = 3 * 10 ** 11
    frequent = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7)], "lang string, k int, phrase string, f long")
    totals = spark.createDataFrame([("en", 10 ** 13 + 9)], "lang string, n long")
    row = co.scored(frequent, totals, 100).first()
    assert row.score == 1000 * (big - 7) * (10 ** 13 + 9) // (big * (big + 1))


def test_filter_misses_nothing(spark):
    h = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    sent = [co.packed(h[i::3].view("u8"), np.full(h[i::3].size, 5), 1, 4) for i in range(3)]
    rows = [tuple(r.values()) for b in sent for r in b.to_pylist()]
    made = co.Filter.of(co.reaching(spark.createDataFrame(rows, co.PACKED), 8, 4))
    assert made(h.view("u8")).all()  # 5 told and 1 untold by each of three shards
    assert co.reaching(spark.createDataFrame(rows, co.PACKED), 9, 4).count() == 0
    others = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 5000)
    assert made(others.view("u8")).sum() < 5


def test_words_and_pieces():
    data, lengths, pieces = co.words_of(pa.array(["A b.C", "", "d", "..", "e,f\tg"]).slice(0))
    ends = np.cumsum(lengths)
    assert [data[e - n:e] for e, n in zip(ends, lengths)] == [b"a", b"b", b"c", b"d", b"e", b"f", b"g"]
    assert pieces[0] == pieces[1] and len(set(pieces.tolist())) == 5 and pieces[5] == pieces[6]
