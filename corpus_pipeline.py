"""Training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and
all but the last return the columns of ``documents``. Written as Parquet, a stage's
result is the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import exact_dedup, mixing, packing, quality, simhash
from tillwise.llm.common import read, stored
from tillwise.llm.queries import (END_ID, MIX_BLOCK, MIX_SHARES, SEQUENCE_SEGMENTS, SEQUENCE_TOKENS, SIMHASH_BITS,
                                  SIMHASH_WORDS, tokenizer_path)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts stays, that of smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of smallest id."""
    return simhash.drop_near_duplicates(docs, SIMHASH_WORDS, SIMHASH_BITS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources by their target weights."""
    return mixing.mixed(docs, MIX_SHARES, MIX_BLOCK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; neighbours in the mix share sequences.

    Reading Parquet deals files by size, not by name, so the order of the mix is found again
    from ids and sources: each task packs a range of positions, and later ranges have greater sequence ids."""
    ordered = mixing.mixed(docs.select("doc_id", "text", "source"), MIX_SHARES, MIX_BLOCK)
    return packing.pack_documents(ordered, tokenizer_path(), END_ID, SEQUENCE_TOKENS, SEQUENCE_SEGMENTS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: EM, fingerprints and the packer's heuristic are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
