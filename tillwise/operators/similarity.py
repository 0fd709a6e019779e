"""Grouping and sequence operators over documents and vectors.

Connected components never emit all pairs of a group: every document links
to one representative per shared key (a star), and components come from
repeated contraction (``functions.components``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import cells
from tillwise.functions.components import components
from tillwise.functions.prefix import keyed_sequence, ordered_prefix_sums
from tillwise.session import reliable_checkpoint


def shared_line_edges(docs: DataFrame) -> DataFrame:
    """Edges doc -> representative (smallest doc id) of every normalised
    non-empty line that occurs in several documents."""
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("doc_id", F.lower(F.trim("line")).alias("line")).where(F.length("line") > 0)
    lines = lines.select("doc_id", F.xxhash64("line").alias("h"), "line").distinct()
    rep = lines.groupBy("h", "line").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    rep = rep.where(F.col("n") > 1)
    e = lines.join(rep, ["h", "line"]).where(F.col("doc_id") != F.col("rep"))
    return e.select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "doc_id") -> DataFrame:
    """Component label = smallest node id reachable (undirected)."""
    labels = reliable_checkpoint(components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    found = labels.join(least, "label").select(F.col("id").alias(node), "component")
    return nodes.select(node).join(found, node, "left").select(node, F.coalesce("component", node).alias("component"))


def semantic_chunks(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", threshold: float = 0.0) -> DataFrame:
    """In key order, start a new chunk where the cosine similarity with
    the previous vector drops below ``threshold``. Keys may have gaps: the
    previous row comes from ``keyed_sequence`` over range partitions, the chunk
    id from range-partitioned running counts."""
    v = vectors.select(F.lit(0).alias("_all"), F.col(key).alias("k"), F.transform(vec, lambda x: x.cast("double")).alias("v"))
    j = keyed_sequence(v, "_all", ["k"], ["v"]).withColumnRenamed("prev_v", "pv")
    dot = F.aggregate(F.zip_with("v", "pv", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    na = F.sqrt(F.aggregate(F.transform("v", lambda a: a * a), F.lit(0.0), lambda s, x: s + x))
    nb = F.sqrt(F.aggregate(F.transform("pv", lambda a: a * a), F.lit(0.0), lambda s, x: s + x))
    cos = F.when(F.col("pv").isNull(), F.lit(None)).otherwise(dot / (na * nb))
    j = j.select("k", cos.alias("cos_prev"))
    j = j.withColumn("_brk", F.when(F.col("cos_prev").isNull() | (F.col("cos_prev") < threshold), 1).otherwise(0))
    out = ordered_prefix_sums(j, [F.col("k")], {"chunk_id": F.col("_brk")})
    return out.select(F.col("k").alias(key), "cos_prev", "chunk_id")


def shingle_sets(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5) -> DataFrame:
    """(doc, shingles): the distinct 64-bit hashes of a document's word ``shingle``-grams, sorted.
    A text of fewer words is one shingle."""
    from tillwise.operators.text import tokens
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - shingle + 1, F.lit(1))),
                        lambda i: F.xxhash64(F.array_join(F.slice("w", i, shingle), " ")))
    return (docs.select(F.col(key).cast("long").alias("doc"), tokens(text).alias("w"))
            .select("doc", F.sort_array(F.array_distinct(grams)).alias("shingles")))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class of each set of shingles is its 128-bit digest."""
    for batch in batches:
        digests = [hashlib.md5(s.values.to_numpy().tobytes()).digest() for s in batch.column("shingles")]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(digests, pa.binary()), batch.column("shingles")],
                                         names=["doc", "class", "shingles"])


def _banded(batches: Iterator[pa.RecordBatch], bands: int, rows: int, seed: int) -> Iterator[pa.RecordBatch]:
    """MinHash bands: one bucket per band from the least of ``rows`` hashes each."""
    draws = np.random.default_rng(seed).integers(0, 1 << 64, (bands * rows, 2), dtype="u8")
    for batch in _named(batches):
        if not batch.num_rows:
            continue
        sets = batch.column("shingles")
        flat, starts = sets.flatten().to_numpy().view("u8"), (sets.offsets.to_numpy() - sets.offsets[0].as_py())[:-1]
        buckets = np.zeros((batch.num_rows, bands), dtype="u8")
        for j, (flip, factor) in enumerate(draws):
            least = np.minimum.reduceat((flat ^ flip) * (factor | np.uint64(1)), starts)
            if j % rows == 0:
                buckets[:, j // rows] = j
            mixed = (buckets[:, j // rows] ^ least) * np.uint64(0x9E3779B97F4A7C15)
            buckets[:, j // rows] = mixed ^ (mixed >> np.uint64(29))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("class"), pa.array(list(buckets.view("i8")), pa.list_(pa.int64()))],
                                         names=["doc", "class", "buckets"])


def _met_here(buckets: np.ndarray, side: np.ndarray, band: int, split: bool) -> np.ndarray:
    """Pairs of a cell that share no bucket of an earlier band (and, in a cell of two blocks, lie on both sides)."""
    here = side[:, None] != side[None, :] if split else ~np.eye(len(side), dtype=bool)
    for k in range(band):
        here &= buckets[:, None, k] != buckets[None, :, k]
    return here


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of a cell that have a pair to compare there."""
    for table, bounds in cells.runs(batches, ["bucket", "lo", "hi"]):
        flat = table.column("buckets").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        side, band = table.column("side").to_numpy(), table.column("band").to_numpy()
        split = table.column("lo").to_numpy() != table.column("hi").to_numpy()
        wanted = np.zeros(table.num_rows, dtype=bool)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo > 1:
                wanted[lo:hi] = _met_here(flat[lo:hi], side[lo:hi], band[lo], split[lo]).any(axis=1)
        yield from table.filter(pa.array(wanted)).to_batches()


def jaccard(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Exact Jaccard similarity of every two sets (distinct values each)."""
    sizes = np.array([len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = n > 1  # what one set alone holds is in no intersection
    keep = several[at]
    row, col = np.repeat(np.arange(len(sets)), sizes)[keep], (np.cumsum(several) - 1)[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(sets), len(sets)))
    for first in range(0, int(several.sum()), columns):
        lo, hi = np.searchsorted(col, [first, first + columns])
        member = np.zeros((len(sets), min(columns, int(several.sum()) - first)), dtype="f4")
        member[row[lo:hi], col[lo:hi] - first] = 1
        common += member @ member.T
    return common / (sizes[:, None] + sizes[None, :] - common)


def _compare(batches: Iterator[pa.RecordBatch], min_jaccard: float) -> Iterator[pa.RecordBatch]:
    """Per cell: the links of each class (b null), and a spanning forest over the pairs of at least ``min_jaccard``."""
    for table, bounds in cells.runs(batches, ["bucket", "lo", "hi"]):
        names, sets = table.column("class").to_pylist(), table.column("shingles").combine_chunks()
        buckets = table.column("buckets").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        side, band = table.column("side").to_numpy(), table.column("band").to_numpy()
        copies = table.column("copies").to_numpy()
        split = table.column("lo").to_numpy() != table.column("hi").to_numpy()
        a, b, n = [], [], []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            near = _met_here(buckets[lo:hi], side[lo:hi], band[lo], split[lo])
            near &= jaccard([sets[i].values.to_numpy() for i in range(lo, hi)]) >= min_jaccard
            count, free = near @ copies[lo:hi], near.any(axis=1)
            linked = np.flatnonzero(free)
            a += [names[lo + i] for i in linked]
            b += [None] * linked.size
            n += count[linked].tolist()
            for root in linked:
                if free[root]:
                    free[root], stack = False, [root]
                    while stack:
                        at = stack.pop()
                        hits = np.flatnonzero(near[at] & free)
                        free[hits] = False
                        stack += hits.tolist()
                        a += [names[lo + i] for i in hits]
                        b += [names[lo + at]] * hits.size
                        n += [0] * hits.size
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())],
                                         names=["a", "b", "n"])


def _near_sets(docs: DataFrame, text: str, key: str, bands: int, rows: int, seed: int, min_jaccard: float,
               block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc, class), classes (class, rep, copies) of equal shingle sets, and what ``_compare`` finds between classes.

    Bands only propose pairs. A pair is compared once, in the first band whose
    bucket it shares, on the shingle sets themselves; sets go only to the cells
    where they have such a pair. A bucket of more than ``block`` classes is split
    (``functions.cells``)."""
    sets = shingle_sets(docs, text, key)
    found = reliable_checkpoint(sets.mapInArrow(lambda x: _banded(x, bands, rows, seed), "doc long, class binary, buckets array<long>"))
    classes = reliable_checkpoint(found.groupBy("class", "buckets").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies")))
    b = classes.select("class", F.posexplode("buckets").alias("band", "bucket"))
    full = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    dealt = cells.deal(b.join(full, "bucket"), "bucket", "class", block).join(classes.select("class", "copies", "buckets"), "class")
    shape = "bucket long, lo int, hi int, side int, band int, class binary, copies long, buckets array<long>"
    names = [x.split()[0] for x in shape.split(", ")]
    wanted = reliable_checkpoint(cells.gathered(dealt.select(*names), "bucket").mapInArrow(_wanted, shape))
    own = (sets.mapInArrow(_named, "doc long, class binary, shingles array<long>")
           .join(wanted.select("class").distinct(), "class", "left_semi")
           .groupBy("class", "shingles").agg(F.count(F.lit(1)).alias("n")).select("class", "shingles"))
    links = reliable_checkpoint(cells.gathered(wanted.join(own, "class"), "bucket").mapInArrow(
        lambda x: _compare(x, min_jaccard), "a binary, b binary, n long"))
    return found.select("doc", "class"), classes.select("class", "rep", "copies"), links


def match_items(docs: DataFrame, text: str = "text", key: str = "doc_id", bands: int = 16, rows: int = 4,
                seed: int = 42, min_jaccard: float = 0.8, block: int = 512) -> DataFrame:
    """Near-duplicate documents by MinHash LSH: (key, match_id, n_links) for each row of ``docs``.

    Two documents are linked if the exact Jaccard similarity of their five-word
    shingle sets is at least ``min_jaccard``; ``n_links`` counts a document's links,
    ``match_id`` is the smallest id of its connected class. Documents of equal sets
    are compared as one. Pairs are counted, not emitted: each in the first band whose
    bucket it shares. Null ids are ignored for ``match_id``, which is null where the
    class has no other."""
    of, classes, found = _near_sets(docs, text, key, bands, rows, seed, min_jaccard, block)
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    labels = components(found.where("b is not null").select("a", "b")).select(F.col("id").alias("class"), "label")
    linked = (classes.join(counts, "class", "left").join(labels, "class", "left")
              .withColumn("label", F.coalesce("label", "class")))
    least = linked.groupBy("label").agg(F.min("rep").alias("match_id"))
    groups = linked.join(least, "label").select("class", "match_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return of.join(groups, "class").select(F.col("doc").alias(key), "match_id", "n_links")


def near_duplicate_groups(docs: DataFrame, min_jaccard: float = 0.8, key: str = "doc_id") -> DataFrame:
    """T18 -> T19: components of the near-duplicate links."""
    return match_items(docs, key=key, min_jaccard=min_jaccard).select(key, F.col("match_id").alias("component"))
