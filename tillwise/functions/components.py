"""Connected components by repeated contraction.

In each round every vertex joins its neighbour (or itself) of least random rank; the
graph of the chosen vertices is what is left. A constant share of the vertices goes
each round, so the number of rounds grows with the logarithm of the graph, chains
included, and the work of all rounds is about that of the first. A vertex with a third
of all edges costs no more than a partial aggregation and joins that Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import measured_checkpoint, reliable_checkpoint


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every vertex of ``edges`` (a, b); vertices of one component share a label."""
    def tidy(e: DataFrame) -> DataFrame:
        return (e.where(F.col("a") != F.col("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    left, maps = measured_checkpoint(tidy(edges)), []
    while not left.isEmpty():
        left, parents = _round(left, len(maps) + 1)
        left = measured_checkpoint(tidy(left))
        maps.append(parents)
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).limit(0)
    labels = maps[-1].select("id", F.col("parent").alias("label"))
    for parents in reversed(maps[:-1]):
        nxt = labels.select(F.col("id").alias("parent"), "label")
        labels = parents.join(nxt, "parent", "left").select("id", F.coalesce("label", "parent").alias("label"))
    return labels


def _round(left: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """The contracted edges, and (id, parent) of every vertex."""
    def rank(c: str):
        return F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("v"))

    def to(c: str) -> DataFrame:
        return parents.select(F.col("id").alias(c), F.col("parent").alias("p" + c))

    both = left.union(left.select("b", "a"))
    parents = reliable_checkpoint(both.groupBy("a").agg(F.min(rank("b")).alias("best"))
                                  .select(F.col("a").alias("id"), F.least("best", rank("a")).getField("v").alias("parent")))
    moved = left.join(to("a"), "a").join(to("b"), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    return moved, parents
