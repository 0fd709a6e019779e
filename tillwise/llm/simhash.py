"""SimHash near duplicates by anchor-point covering.

Fingerprints have 64 bits. Of two that differ in at most t <= 5 bits, one half
differs in at most 2. The anchors are, for each half, the words of the perfect
Hamming code of length 31 (the half's top bit is left out of the anchor, not of the
comparison): every 31-bit word is within its covering radius 1 of an anchor. Two words
at distance 2 have a word between them at distance 1 from both, whose anchor is then
within 1 + 1 = 2 of both. So each fingerprint is replicated, per half, to every anchor
within radius 2 (16 anchors, or 1 where it is an anchor itself), any two close
fingerprints meet at an anchor, and all at one anchor are compared on 64 bits.
The anchors come from the syndrome alone: those at distance 2 or less are the word
with bits i and j flipped, i xor j being its syndrome (0 standing for no bit).

Only distinct fingerprints are linked, so copies cost nothing; an anchor that many
distinct ones share is split into bounded cells (``cells``). A cell gives a spanning
star per component, never all pairs.

Defined results: null text and text without words have fingerprint 0, linked like any
other; null ids are ignored for the component's id, which is null where there is no
other; repeated rows share their component, of which dropping keeps one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillwise.functions import cells
from tillwise.functions.components import components
from tillwise.llm.common import checkpointed, fresh, one_row_each, slices, texts

BLOCK = 4096
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a bit is 1 if set in over half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(map(len, words), lambda a, n: a + n + 1, initial=0)][1:]
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest, total, n = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64), len(last)
    for k in range(0, n, HASHES_AT_ONCE):
        hashes = b"".join([digest(line[s:e], seed) for s, e in zip(starts[k:k + HASHES_AT_ONCE], last[k:k + HASHES_AT_ONCE])])
        total += np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with fp as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = [fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(fps, dtype="u8").view("i8"))], names=["doc_id", "fp"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return texts(narrow).mapInArrow(run, "doc_id long, fp long")


def _syndrome(word: Column) -> Column:
    """Exclusive or of the positions 1..31 of the set bits."""
    parts = []
    for k in range(5):
        mask = sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1)
        parts.append(F.shiftleft(F.bit_count(word.bitwiseAND(F.lit(mask).cast("long"))) % 2, k))
    return parts[0] + parts[1] + parts[2] + parts[3] + parts[4]


def at_anchors(fps: DataFrame) -> DataFrame:
    """(anchor, fp): every fingerprint at each anchor within radius 2 of a half."""
    half = F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))
    low = F.col("fp").bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))
    flip = lambda i: F.expr(f"shiftright(shiftleft(1L, {i}), 1)")
    return (fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("half"), low.alias("w")),
                                               F.struct(F.lit(1).alias("half"), half.alias("w")))).alias("x"))
            .select("fp", "x.half", "x.w").withColumn("s", _syndrome(F.col("w")))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(31)))).withColumn("j", F.col("i").bitwiseXOR(F.col("s")))
            .where((F.col("i") < F.col("j")) | (F.col("s") == 0) & (F.col("i") == 0))
            .select((F.shiftleft(F.col("half").cast("long"), 32)
                     + F.col("w").bitwiseXOR(flip("i")).bitwiseXOR(flip("j"))).alias("anchor"), "fp"))


def stars(fps: np.ndarray, most: int) -> list[tuple[int, np.ndarray]]:
    """(root, others) for each component of at least two fingerprints within ``most`` bits."""
    out, left = [], fps
    while left.size > 1:
        root, left, stack, found = left[0], left[1:], [left[0]], []
        while stack and left.size:
            near = np.bitwise_count(left ^ stack.pop()) <= most
            if near.any():
                hits = left[near]
                found.append(hits)
                stack.extend(hits)
                left = left[~near]
        if found:
            out.append((root, np.concatenate(found)))
    return out


def links(fps: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(a, b): fingerprints that are connected; spanning stars of the cells."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the anchors cover up to 5 differing bits")
    dealt = cells.gathered(cells.deal(at_anchors(fps), "anchor", "fp", block).select("anchor", "lo", "hi", "fp"), "anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in cells.runs(batches, ["anchor", "lo", "hi"]):
            fp = table.column("fp").to_numpy().view("u8")
            size = np.diff(bounds)
            first = bounds[:-1][size == 2]
            near = np.bitwise_count(fp[first] ^ fp[first + 1]) <= max_bits
            a, b = [fp[first[near]]], [fp[first[near] + 1]]
            for k in np.flatnonzero(size > 2):
                for root, others in stars(fp[bounds[k]:bounds[k + 1]], max_bits):
                    a.append(np.full(others.size, root))
                    b.append(others)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view("i8")) for x in (a, b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _labelled(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp), and (fp, label, component_id) of each distinct fingerprint."""
    rows = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(distinct.select("fp"), max_bits, block)).select(F.col("id").alias("fp"), "label")
    labelled = distinct.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows, labelled.select("fp", "label").join(least, "label")


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id of the component) per row."""
    rows, of = _labelled(docs, shingle, max_bits, id_col, text_col, block)
    return rows.join(of.drop("label"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def with_fingerprint(docs: DataFrame, shingle: int, text_col: str, name: str) -> DataFrame:
    """``docs`` with the fingerprint in the column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            fps = [fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(fps, dtype="u8").view("i8"))], names=[*batch.schema.names, name])

    return texts(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def drop_near_duplicates(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, of smallest id (and fingerprint); all columns stay.

    An id that one row has finds its row; rows of null or repeated ids are found by fingerprint too."""
    own, kept, fp, repeated = fresh(docs, "__id", "__kept", "__fp", "__several")
    rows, of = _labelled(docs, shingle, max_bits, id_col, text_col, BLOCK)
    chosen = checkpointed(rows.join(of, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                          .groupBy("label").agg(F.min(F.struct("fp", "doc_id")).alias("x"))
                          .select(F.col("x.doc_id").alias(own), F.col("x.fp").alias(kept)))
    several = checkpointed(rows.groupBy(F.col("doc_id").alias(repeated)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    by_id = docs[id_col].cast("long").eqNullSafe(F.col(own))
    if several.isEmpty():
        return docs.join(chosen, by_id, "left_semi")
    unique = chosen.join(several, F.col(own).eqNullSafe(F.col(repeated)), "left_anti")
    shared = chosen.join(several, F.col(own).eqNullSafe(F.col(repeated)), "left_semi")
    found = with_fingerprint(docs.join(several, docs[id_col].cast("long").eqNullSafe(F.col(repeated)), "left_semi"), shingle, text_col, fp)
    found = found.join(shared, found[id_col].cast("long").eqNullSafe(F.col(own)) & (F.col(fp) == F.col(kept)))
    return (docs.join(unique, by_id, "left_semi")
            .unionByName(one_row_each(found.drop(fp), [own, kept], text_col)))
