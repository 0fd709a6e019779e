"""Comparison cells: members that share a key are compared within bounded blocks.

A key with more members than ``block`` is not one cell: its members are dealt over
blocks by hash, and each pair of blocks is a cell of its own, so any two members still
meet (in exactly one cell, or within their common block) while no task holds more than
about two blocks. All other keys are one cell. Nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal(members: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """``members`` with ``lo`` and ``hi`` (the cell's two blocks) and ``side`` (the row's own block)."""
    hot = (members.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select(key, F.ceil(F.col("n") / block).alias("blocks")))
    own = F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(member, F.lit("block")), "blocks"))
    return (members.join(hot, key, "left").withColumn("side", own.cast("int"))
            .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                                           .otherwise(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))))
            .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
            .drop("other", "blocks"))


def gathered(cells: DataFrame, key: str) -> DataFrame:
    """Cells brought together, each a run of consecutive rows."""
    return cells.repartition(F.col(key), F.col("lo"), F.col("hi")).sortWithinPartitions(key, "lo", "hi")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole runs of equal ``keys``, with the runs' bounds."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        change = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held and all(batch.column(k)[-1] == held[0].column(k)[0] for k in keys):
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch])
        bounds = cut(table)
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
        held = table.slice(bounds[-2]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)
