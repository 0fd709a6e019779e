import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Columns that operators use themselves; an input may have them too.
CLASHING = ("kept", "h", "n", "row", "prefix", "bytes", "address", "fp", "k", "th", "label", "score", "shard", "anchor", "position", "hash128",
            "__id", "__sha", "__n", "__row", "__kept", "__fp", "__several", "__found", "__map", "__address")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice('abcde')}" for _ in range(n))


def corpus(seed: int = 7, n: int = 60) -> list[tuple]:
    """Odd rows first: null and empty texts, null ids, repeated rows, a very long text, then prose with copies."""
    rng = random.Random(seed)
    long = prose(rng, 30_000)
    shared = prose(rng, 70)
    rows = [(0, None, None, None, None), (1, "", "en", "s1", 0), (None, "no id here at all", "en", "s1", 1), (2, " \t\n ", "en", None, 3),
            (3, "ONE", "en", "s2", 3), (3, "ONE", "en", "s2", 3), (4, "one", "en", "s2", 3), (5, long, "en", "s1", 1), (6, long + " end", "en", "s1", 1),
            (7, "É CAFÉ Ünï " + " x y", "fr", "s3", 9)]
    for i in range(10, 10 + n):
        text = prose(rng, rng.randrange(1, 200))
        if i % 5 == 0:
            text += " " + shared + " " + prose(rng, 30)
        if i % 9 == 0:
            text = rows[-1][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    return rows


@pytest.fixture(scope="session")
def docs_rows():
    return corpus()


@pytest.fixture()
def docs(spark, docs_rows):
    return spark.createDataFrame(docs_rows, SCHEMA).repartition(5)


@pytest.fixture()
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def clashing(docs):
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHING])
