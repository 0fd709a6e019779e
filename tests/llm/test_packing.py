import random
import zlib

import numpy as np
import pytest

from tillwise.llm import packing
from tillwise.llm.packing import Packer
from tillwise.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def check(rows, ids, size):
    sequences = {}
    covered = {}
    for r in rows:
        own = ids[r["doc_id"], r["doc_tokens"]]
        piece = own[r["start"]:r["start"] + r["length"]]
        assert len(piece) == r["length"] > 0
        assert zlib.crc32(np.array(piece, dtype="<u4").tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        covered.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        assert at == size or at & (at - 1) == 0  # no padding
    return covered


def test_documents_round_trip(docs, docs_rows, clashing, tokenizer):
    ids = {}
    for i, t, *_ in docs_rows:
        own = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        ids[i, len(own)] = own
    for size in (64, 4096):
        rows = packing.pack_documents(docs, tokenizer_path(), 2, size).collect()
        covered = check(rows, ids, size)
        assert sum(r["length"] for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in docs_rows)
        for (i, n), parts in covered.items():
            if i != 3:  # a row that comes twice
                at = 0
                for start, length in sorted(parts):
                    assert start == at
                    at += length
                assert at == n
    assert packing.pack_documents(clashing, tokenizer_path(), 2).count() == packing.pack_documents(docs, tokenizer_path(), 2).count()


def test_empty_table(empty_docs):
    assert packing.pack_documents(empty_docs, tokenizer_path(), 2).count() == 0


def test_words_equal_whole_texts(tokenizer):
    words = packing.word_ids(tokenizer_path())
    for t in ["", "  ", "It's <|endoftext|> here", "Été Straße ÄÖÜ 12.5% don't\tx\r\ny", "漢字 İ ǅ é x", "a b ªº µ ×÷", "''s''", "\x0b\x0cfoo", "ÿŸ",
              "x" * 5000, "éa ́", "a\x1cb c\x85d", "1234 5,6%%% ***the&&&"]:
        assert np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() == words.text(t), t


def test_dot_product_heuristic_under_three_limits():
    rng = random.Random(1)
    for cut in (False, True):
        limits = (100, 6, 50)
        packer = Packer(limits, cut, waiting=32)
        need = {}
        for i in range(500):
            tokens = rng.randrange(1, 60)
            loss = rng.randrange(0, min(tokens, 40) + 1)
            need[i] = (tokens, loss)
            packer.add(i, 0, tokens, loss)
        packer.finish()
        bins, got = {}, {}
        for key, start, tokens, sequence, offset, loss in packer.out:
            b = bins.setdefault(sequence, [0, 0, 0])
            assert offset == b[0]
            b[0] += tokens
            b[1] += 1
            b[2] += loss
            got.setdefault(key, []).append((start, tokens, loss))
        assert all(x <= m for b in bins.values() for x, m in zip(b, limits))
        for key, parts in got.items():
            at = 0
            for start, tokens, _ in sorted(parts):
                assert start == at
                at += tokens
            assert (at, sum(x for _, _, x in parts)) == need[key]
        assert len(got) == 500
        if not cut:
            assert len(packer.out) == 500
            least = max(sum(t for t, _ in need.values()) / 100, sum(x for _, x in need.values()) / 50, 500 / 6)
            assert len(bins) <= 1.2 * least + 1


def test_instruction_examples(spark):
    from pyspark.sql import functions as F
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    n = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    examples = turns.groupBy(F.col("conv_id").alias("example_id")).agg(
        F.sum(n).alias("tokens"), F.count(F.lit(1)).alias("segments"), F.sum(F.when(F.col("role") == "assistant", n).otherwise(0)).alias("loss_tokens"))
    most = examples.agg(F.max("tokens"), F.max("segments"), F.max("loss_tokens")).first()
    limits = tuple(2 * x for x in most)
    placed = packing.pack_examples(examples, *limits)
    rows = placed.collect()
    assert len(rows) == examples.where("tokens > 0").count()
    for r in placed.groupBy("sequence_id").agg(F.sum("tokens"), F.sum("segments"), F.sum("loss_tokens")).collect():
        assert all(x <= m for x, m in zip(tuple(r)[1:], limits))
    with pytest.raises(Exception, match="exceeds a limit"):
        packing.pack_examples(examples, 1, 1, 1).collect()


def test_short_rows_leave_little_padding(spark, tokenizer):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(("a", "be", "see")) for _ in range(rng.randrange(4)))) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = packing.pack_documents(docs, tokenizer_path(), 2, 4096, 4096).collect()
    used = {}
    for r in got:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    padded = sum(n if n & (n - 1) == 0 else 4096 for n in used.values())
    assert sum(used.values()) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert padded <= 1.01 * sum(used.values())


def test_small_examples_fill_sequences():
    packer = Packer((100, 1000, 100), False, waiting=4)
    for i in range(1000):
        packer.add(i, 0, 1 + i % 3, 1)
    packer.finish()
    tokens = {}
    for _, _, n, sequence, _, _ in packer.out:
        tokens[sequence] = tokens.get(sequence, 0) + n
    assert len(packer.out) == 1000 and sum(n < 97 for n in tokens.values()) <= 1


def test_another_vocabulary_gives_its_own_ids(spark):
    import os
    folder = os.path.dirname(tokenizer_path())
    from tokenizers import Tokenizer
    others = [f"{folder}/{f}" for f in sorted(os.listdir(folder)) if f.endswith(".json") and f != "word_bpe_49k.json"]
    texts = ["It's 12.5% of Don't", "Été Straße", "plain words HERE", ""]
    tried = 0
    for path in others:
        try:
            own = Tokenizer.from_file(path)
        except Exception:
            continue  # not of this library
        words = packing.WordIds(path)
        tried += 1
        for t in texts:
            assert words.text(t) == np.array(own.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), (path, t)
    assert tried or not others
