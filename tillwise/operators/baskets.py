"""Co-purchase ranking (T23): how often items are bought together, as a blocked sparse product.

A basket of at most ``small`` items emits its pairs, (small - 1) / 2 for each of its rows
at most, which are counted as any group is. Larger baskets do not: their items fall into
blocks by hash, so that a block has about ``block`` items, and a basket has one list of
items for each block that it touches. A cell joins the lists of two blocks of the same
basket and adds them up in a dense table of counts, which leaves the cell once, as its
entries over zero: a basket of many thousand items costs a row for each two blocks it
touches. Cells that get many baskets (those of an item that a third of the baskets hold,
say) are dealt over several tasks by basket, and the tables' entries are summed. (Blocks
alone would give each few small baskets a cell: with many items, as many cells as pairs.)

Defined results: an item counts once in a basket however often it is in it; rows without a
basket or an item take no part; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.functions.topk import top_k_per_group
from tillwise.session import reliable_checkpoint

BLOCK, LISTS, SMALL = 1024, 50_000, 32


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of (left, right, part): (a, b, n), a < b."""
    for table, bounds in runs(batches, ["left", "right", "part"]):
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            run = table.slice(lo, hi - lo).combine_chunks()
            lists = [run.column(c).combine_chunks() for c in ("a", "b")]
            flat = [x.flatten().to_numpy() for x in lists]
            starts = [np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())]) for x in lists]
            names, at = zip(*(np.unique(x, return_inverse=True) for x in flat))
            count = np.zeros((names[0].size, names[1].size), dtype="i8")
            small = np.diff(starts[0]) * np.diff(starts[1]) <= 64
            # pairs of small lists are added many lists at a time, a large one by itself
            for part in np.array_split(np.flatnonzero(small), max(1, int(small.sum()) // 4096)):
                m, n = starts[0][part + 1] - starts[0][part], starts[1][part + 1] - starts[1][part]
                if not part.size:
                    continue
                size = m * n
                owner = np.repeat(np.arange(part.size), size)
                within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                x = at[0][starts[0][part][owner] + within // n[owner]]
                y = at[1][starts[1][part][owner] + within % n[owner]]
                np.add.at(count, (x, y), 1)
            for i in np.flatnonzero(~small):
                count[np.ix_(at[0][starts[0][i]:starts[0][i + 1]], at[1][starts[1][i]:starts[1][i + 1]])] += 1
            x, y = np.nonzero(count)
            a, b, n = names[0][x], names[1][y], count[x, y]
            keep = a < b if run.column("left")[0] == run.column("right")[0] else a != b
            a, b, n = a[keep], b[keep], n[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(n)], names=["a", "b", "n"])


def _held(rows: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, item), each once."""
    return reliable_checkpoint(rows.select(rows[basket].alias("basket"), rows[item].cast("long").alias("item"))
                               .where("basket is not null and item is not null").distinct())


def pair_counts(rows: DataFrame, basket: str, item: str, block: int = BLOCK, lists: int = LISTS, small: int = SMALL) -> DataFrame:
    """(a, b, n): baskets that hold both items, a < b, n > 0. Items are whole numbers of 64 bits."""
    return _pairs(_held(rows, basket, item), block, lists, small)


def _pairs(held: DataFrame, block: int = BLOCK, lists: int = LISTS, small: int = SMALL) -> DataFrame:
    large = reliable_checkpoint(held.groupBy("basket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > small).select("basket"))
    few = held.join(large, "basket", "left_anti").groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    first = few.select("items", F.posexplode("items").alias("at", "a"))
    found = first.select("a", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    if large.isEmpty():
        return found
    return found.unionByName(_block_counts(held.join(large, "basket", "left_semi"), block, lists)).groupBy("a", "b").agg(F.sum("n").alias("n"))


def _block_counts(held: DataFrame, block: int, lists: int) -> DataFrame:
    held = reliable_checkpoint(held)
    blocks = max(1, math.ceil(held.select("item").distinct().count() / block))
    of = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    # a list has at most the items of one block
    per = reliable_checkpoint(held.groupBy("basket", of.alias("at")).agg(F.sort_array(F.collect_list("item")).alias("items")))
    left = per.select("basket", F.col("at").alias("left"), F.col("items").alias("a"))
    right = per.select("basket", F.col("at").alias("right"), F.col("items").alias("b"))
    cells = left.join(right, "basket").where("left <= right and (left < right or size(a) > 1)")
    cells = reliable_checkpoint(cells)
    load = cells.groupBy("left", "right").agg(F.ceil(F.count(F.lit(1)) / lists).cast("int").alias("parts"))
    dealt = cells.join(load, ["left", "right"]).withColumn("part", F.expr("cast(pmod(xxhash64(basket), parts) as int)"))
    keys = ["left", "right", "part"]
    return (dealt.select(*keys, "a", "b").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_add, "a long, b long, n long")
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def cart_ranking(rows: DataFrame, basket: str, item: str, top: int = 5, least: int = 2, **sizes) -> DataFrame:
    """Per item the ``top`` others by lift = n_both * baskets / (n_item * n_other), of those bought
    together in ``least`` baskets or more; ties by n_both, then the smaller item."""
    held = _held(rows, basket, item)
    pairs = reliable_checkpoint(_pairs(held, **sizes).where(F.col("n") >= least))
    single = reliable_checkpoint(held.groupBy("item").agg(F.count(F.lit(1)).alias("n_item")))
    baskets = held.agg(F.count_distinct("basket")).first()[0]
    both = pairs.select(F.col("a").alias("item"), F.col("b").alias("other"), F.col("n").alias("n_both")).union(pairs.select("b", "a", "n"))
    lift = F.col("n_both") * F.lit(float(baskets)) / (F.col("n_item") * F.col("n_other"))
    scored = (both.join(single, "item").join(single.select(F.col("item").alias("other"), F.col("n_item").alias("n_other")), "other")
              .withColumn("lift", lift))
    return top_k_per_group(scored, ["item"], [F.desc("lift"), F.desc("n_both"), F.asc("other")], top).select(
        "item", "rank", "other", "n_both", "n_item", "n_other", "lift")
