import re
import string

import pytest
import xxhash

import corpus_pipeline
from tillwise.llm import exact_dedup, mixing, packing, quality
from tillwise.llm.common import read
from tillwise.llm.queries import MIX_BLOCK, MIX_SHARES, tokenizer_path

SF = "/root/testdata/sf0.001"
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [], read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns(stages):
    assert len(stages) == 5
    for docs, result in stages[:-1]:
        assert result.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, stages):
    docs, kept = stages[0]
    rows = quality.classify(docs, quality.fit(docs, read(spark, SF, "labels"))).collect()
    assert ids(kept) == sorted(r["doc_id"] for r in rows if r["kept"]) and len(rows) > kept.count()
    labels = {r["doc_id"]: r for r in read(spark, SF, "labels").collect()}
    good = [r for r in rows if r["doc_id"] in labels and labels[r["doc_id"]]["quality"] == 1 and labels[r["doc_id"]]["toxic"] == 0]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)


def test_exact(stages):
    docs, kept = stages[1]
    least = {}
    for r in docs.collect():
        t = (r["text"] or "").translate(LOW)
        least[t] = min(least.get(t, r["doc_id"]), r["doc_id"])
    assert ids(kept) == sorted(least.values())


def test_near(stages):
    docs, kept = stages[2]
    fps = {r["doc_id"]: fingerprint(r["text"]) for r in docs.collect()}
    least = {i: i for i in fps}
    for _ in fps:
        before = dict(least)
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    least[a] = min(least[a], least[b])
        if before == least:
            break
    assert ids(kept) == sorted(i for i in least if least[i] == i)


def test_mixing_keeps_all_in_order(stages):
    docs, mixed = stages[3]
    assert sorted(map(str, docs.collect())) == sorted(map(str, mixed.collect()))
    where = {r["doc_id"]: r["position"] for r in mixing.mix(docs, MIX_SHARES, MIX_BLOCK).collect()}
    seen = [where[r["doc_id"]] for r in mixed.coalesce(1).collect()] if mixed.rdd.getNumPartitions() == 1 else None
    assert seen is None or seen == sorted(seen)


def test_packing_holds_every_token(stages):
    docs, pieces = stages[4]
    words = packing.word_ids(tokenizer_path())
    want = {r["doc_id"]: len(words.text(r["text"] or "")) // 4 + 1 for r in docs.collect()}
    got = {}
    for r in pieces.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_run_equals_stages(spark, stages):
    a = sorted((r["doc_id"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect())
    assert a == sorted((r["doc_id"], r["doc_tokens"]) for r in stages[4][1].select("doc_id", "doc_tokens").distinct().collect())
    assert exact_dedup.exact_classes(stages[2][1]).where("not kept").count() == 0


def test_packing_follows_the_mix_over_several_files(spark, tmp_path):
    rows = [(i, f"w{i} " * (1 + (i * 7) % 300), "en", "src0" if i % 3 else f"src{i % 21}", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        mixing.mixed(docs, MIX_SHARES, MIX_BLOCK).write.option("maxRecordsPerFile", 217).parquet(str(tmp_path / "mix"))
        mixed = spark.read.parquet(str(tmp_path / "mix"))
        assert mixed.rdd.getNumPartitions() > 8
        pieces = corpus_pipeline.pack(spark, mixed, SF).collect()
        where = {r["doc_id"]: r["position"] for r in mixing.mix(docs, MIX_SHARES, MIX_BLOCK).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    places = {}
    for r in pieces:
        places.setdefault(r["sequence_id"] >> 33, set()).add(where[r["doc_id"]])
    assert len(places) > 4 and {p for x in places.values() for p in x} == set(range(len(rows)))
    spans = [(min(places[k]), max(places[k])) for k in sorted(places)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
