"""Hard negatives by inner product, with coordinate pruning in length buckets (LEMP).

Rows are ranged by label and length into blocks of about ``block`` rows, anchors are dealt into
chunks, and a block meets a chunk in one cell. In a cell, rows go by in buckets of falling
length. A bucket has its normalised coordinates in sorted lists. From the least score that an
anchor still has to reach follows a least cosine for the bucket; if it is above 1, the bucket
is passed over. Else the anchor's focus coordinates (its largest) must lie in ranges that
follow from that cosine, the list of each gives a range of rows, and only rows in all these
ranges are verified by the exact integer product. What an anchor has to reach rises as its
list fills; before, it is unbounded for positives and the least allowed score for negatives.

Two rounds: positives (of the anchor's label, so only blocks that have it take part), then
negatives within the bounds that each positive's score sets. A cell returns a few rows for each anchor;
these lists are merged by ranks within salted groups. No pairs leave a cell otherwise, and
neither anchors nor rows are broadcast or collected. The work is anchors times rows in
blocks at worst: vectors of few pairs above the bound are pruned well, others hardly.

Defined results: rows with a null label or vector, or a null or non-finite component, take no
part; vectors of different length are not compared; repeated rows are separate rows with
equal results (an anchor's copy may be its positive); a null id is never an anchor, and
comes last among ties; an empty vector's products are 0; an anchor without a positive or a
negative gives no row; an empty table gives none; further columns are not read. Components
of 2 ** 26 and more after scaling are an error, since scores would leave 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.functions.topk import top_k_per_group
from tillwise.llm.common import checkpointed, stored

BLOCK, CHUNK, BUCKET, FOCUS = 4096, 512, 512, 2
LIMIT = 1 << 26
NONE = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, label: Column, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, label, q, copies) of the rows that take part, each component floor(scale * x)."""
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    usable = F.col("label").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("v", lambda x: F.when(F.abs(x * scale) < LIMIT, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for scores of 64 bits"))).cast("int"))
    return rows.where(F.coalesce(usable, F.lit(False))).groupBy("id", "label", scaled.alias("q")).agg(F.count(F.lit(1)).alias("copies"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().astype("i8").reshape(len(flat), -1)


def _unit(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    return x / np.where(length > 0, length, 1.0)[:, None]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact: in doubles as long as no sum can pass 2 ** 53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return (a.astype("f8") @ b.astype("f8").T).astype("i8") if most < 1 << 53 else a @ b.T


def feasible(anchors: np.ndarray, rows: np.ndarray, cosine: np.ndarray, focus: int = FOCUS) -> np.ndarray:
    """Pairs that the ranges of the anchors' focus coordinates allow (unit vectors, least cosine of each anchor)."""
    out = np.ones((len(anchors), len(rows)), dtype=bool)
    angle = np.arccos(np.clip(cosine, -1.0, 1.0))
    largest = np.argsort(-np.abs(anchors), axis=1, kind="stable")[:, :focus]
    for f in np.unique(largest):
        who = np.flatnonzero((largest == f).any(axis=1))
        own = np.arccos(np.clip(anchors[who, f], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, own + angle[who])) - 1e-9
        high = np.cos(np.maximum(0.0, own - angle[who])) + 1e-9
        order = np.argsort(rows[:, f], kind="stable")  # the sorted coordinate list
        place = np.empty(len(rows), dtype="i4")
        place[order] = np.arange(len(rows))
        values = rows[order, f]
        first, last = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
        out[who] &= (place >= first[:, None]) & (place < last[:, None])
    return out


class Lists:
    """The best ``k`` (score, id, weight) of each list, higher scores and then smaller ids first, null ids last."""

    def __init__(self, number: int, k: int):
        self.k, self.least = k, np.full(number, NONE)
        self.rows = [np.zeros(0, dtype="i8") for _ in range(5)]  # list, score, id, no id, weight

    def add(self, *rows: np.ndarray) -> None:
        if not rows[0].size:
            return
        every = [np.concatenate([a, b]) for a, b in zip(self.rows, rows)]
        order = np.lexsort((every[2], every[3], -every[1], every[0]))
        every = [x[order] for x in every]
        heads = np.searchsorted(every[0], every[0])
        rank = np.arange(every[0].size) - heads
        self.rows = [x[rank < self.k] for x in every]
        full = every[0][rank == self.k - 1]
        self.least[full] = every[1][rank == self.k - 1]


def _cell(table: pa.Table, k: int) -> pa.RecordBatch | None:
    """Anchors (column ``low`` not null: bounds of the scores of each of its lists) against rows."""
    is_anchor = np.asarray(table.column("anchor").is_valid())
    size = np.asarray(table.column("size"))
    out: list[list[np.ndarray]] = []
    for dim in np.unique(size).tolist():
        a_at, r_at = np.flatnonzero(is_anchor & (size == dim)), np.flatnonzero(~is_anchor & (size == dim))
        if a_at.size and r_at.size:
            out += _met(table.take(pa.array(a_at)), table.take(pa.array(r_at)), k)
    if not out:
        return None
    anchor, bound, score, ident, none, weight = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(bound), pa.array(score), pa.array(ident, mask=none.astype(bool)), pa.array(weight)],
                                      names=["anchor", "bound", "score", "id", "copies"])


def _met(anchors: pa.Table, rows: pa.Table, k: int) -> list[list[np.ndarray]]:
    a, r = _matrix(anchors.column("q")), _matrix(rows.column("q"))
    a_label, r_label = (np.asarray(t.column("label")) for t in (anchors, rows))
    a_id = np.asarray(anchors.column("id"))
    none = np.asarray(rows.column("id").is_null()).astype("i8")
    r_id, copies = rows.column("id").fill_null(0).to_numpy(), rows.column("copies").to_numpy()
    a_length, r_length = (np.sqrt((x.astype("f8") ** 2).sum(axis=1)) for x in (a, r))
    a_unit = _unit(a, a_length)
    low, high = (anchors.column(c).to_pylist() for c in ("low", "high"))
    number = np.array([1 if x is None else len(x) for x in low])
    owner = np.repeat(np.arange(len(a)), number)
    first = np.cumsum(number) - number
    same = low[0] is None
    floor = np.full(owner.size, NONE) if same else np.array([x for y in low for x in y], dtype="i8")
    top = np.full(owner.size, np.iinfo(np.int64).max) if same else np.array([x for y in high for x in y], dtype="i8")
    lists = Lists(owner.size, k)
    order = np.argsort(-r_length, kind="stable")
    for at in np.split(order, range(BUCKET, len(order), BUCKET)):
        longest = r_length[at[0]]
        need = np.minimum.reduceat(np.maximum(lists.least, floor), first)  # of each anchor, over its lists
        reach = a_length * longest
        cosine = np.where(reach > 0, need / np.where(reach > 0, reach, 1.0), np.where(need > 0, 2.0, -1.0))
        # a positive need is met by the longest row first; a negative one says nothing of shorter rows
        cosine = np.where(need > 0, cosine - 1e-9, -1.0)
        who = np.flatnonzero(cosine <= 1.0)
        if not who.size:
            continue
        label = a_label[who][:, None] == r_label[at][None, :]
        there = feasible(a_unit[who], _unit(r[at], r_length[at]), cosine[who]) & (label if same else ~label)
        live_rows = np.flatnonzero(there.any(axis=0))
        if not live_rows.size:
            continue
        at, there = at[live_rows], there[:, live_rows]
        score = _product(a[who], r[at])
        weight = np.broadcast_to(copies[at], there.shape)
        if same:  # an anchor is not its own positive, but its copies are
            self_ = (a_id[who][:, None] == r_id[at][None, :]) & (none[at] == 0)
            x, y = np.nonzero(self_ & there)
            equal = (a[who[x]] == r[at[y]]).all(axis=1)
            weight = weight.copy()
            weight[x[equal], y[equal]] -= 1
            there &= weight > 0
        hits = there & (score >= need[who][:, None])
        x, y = np.nonzero(hits)
        s = score[x, y]
        for j in range(int(number.max(initial=0))):
            mine = number[who[x]] > j
            of = first[who[x[mine]]] + j
            fits = (s[mine] >= np.maximum(lists.least[of], floor[of])) & (s[mine] <= top[of])
            of, yy = of[fits], at[y[mine][fits]]
            lists.add(of, s[mine][fits], r_id[yy], none[yy], weight[x[mine][fits], y[mine][fits]])
    which, score, ident, none, weight = lists.rows
    anchor = anchors.column("anchor").to_numpy()[owner[which]]
    bound = np.asarray([0] if same else [x for y in anchors.column("bounds").to_pylist() for x in y], dtype="i8")
    return [[anchor, np.zeros(which.size, dtype="i8") if same else bound[which], score, ident, none, weight]]


FOUND = "anchor long, bound long, score long, id long, copies long"


def _best(cells: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in runs(batches, ["block", "chunk"]):
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                found = _cell(table.slice(lo, hi - lo).combine_chunks(), k)
                if found:
                    yield found

    found = cells.repartition("block", "chunk").sortWithinPartitions("block", "chunk").mapInArrow(run, FOUND)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # a row of several copies takes as many places
    few = top_k_per_group(found, ["anchor", "bound"], order, k, salt_key=F.xxhash64("id"))
    single = few.drop("rank").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    return top_k_per_group(single, ["anchor", "bound"], [*order, F.asc("copy")], k, salts=1).select("anchor", "bound", "score", "id", "rank")


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` as from ``quantised``. Negatives score from ``low`` to ``high`` percent of the positive's score."""
    every = rows.withColumn("length", F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    every = checkpointed(every)
    n = every.count()
    blocks = max(1, math.ceil(n / block))
    spread = every.repartitionByRange(blocks, F.col("label"), F.desc("length"), F.col("id"), F.xxhash64("q"))
    table = stored(spread.withColumn("block", F.spark_partition_id()))
    own = table.where(F.coalesce(anchor, F.lit(False))).withColumn("anchor", F.xxhash64("id", "label", "q"))
    own = checkpointed(own.select("anchor", "id", "label", "q", "copies"))
    chunks = max(1, math.ceil(own.count() / chunk))
    of = F.pmod(F.xxhash64("anchor", F.lit("chunk")), F.lit(chunks)).cast("int").alias("chunk")
    held = table.select("block", "label").distinct()
    held = checkpointed(held)

    def cells(mine: DataFrame) -> DataFrame:
        """``mine``: anchors by block, with the bounds of their lists."""
        columns = ["block", "chunk", "anchor", "id", "label", F.size("q").alias("size"), "q", "copies", "bounds", "low", "high"]
        mine = mine.withColumn("chunk", of)
        wanted = mine.select("block", "chunk").distinct()
        other = (table.join(wanted, "block").withColumn("anchor", F.lit(None).cast("long"))
                 .withColumns({c: F.lit(None).cast("array<long>") for c in ("bounds", "low", "high")}))
        return mine.select(*columns).unionByName(other.select(*columns))

    unbounded = {c: F.lit(None).cast("array<long>") for c in ("bounds", "low", "high")}
    chosen = _best(cells(own.join(held, "label").withColumns(unbounded)), positives)
    chosen = checkpointed(chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")))

    scores = chosen.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("bounds"))  # ``positives`` at most
    bounded = own.join(scores, "anchor").withColumns({
        "low": F.transform("bounds", lambda p: F.ceil(p * low / F.lit(100).cast("decimal(3,0)")).cast("long")),
        "high": F.transform("bounds", lambda p: F.floor(p * high / F.lit(100).cast("decimal(3,0)")).cast("long"))})
    foreign = held.groupBy("block").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    # all blocks but those that have no label other than the anchor's
    everywhere = bounded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(foreign, "block")
    everywhere = everywhere.where((F.col("least") != F.col("label")) | (F.col("most") != F.col("label"))).drop("least", "most")
    found = _best(cells(everywhere), negatives)
    out = (chosen.join(found.withColumnRenamed("bound", "positive_score").withColumnRenamed("score", "negative_score"), ["anchor", "positive_score"])
           .join(own.select("anchor", F.col("id").alias("anchor_id"), "copies"), "anchor")
           .withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", "negative_score")
