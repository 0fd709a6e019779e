"""Exact top-k per group that stays bounded when one group is huge.

A plain ``row_number() over (partition by g order by ...)`` sorts a whole
group in one task. Here rows are first ranked inside (group, salt) buckets,
only the best ``k`` of each bucket survive, and the final rank runs over at
most ``k x salts`` rows per group. There are as many salts as shuffle
partitions, so a bucket shrinks as the cluster grows. The result equals the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    rank_col: str = "rank", salts: int | None = None, salt_key: Column | None = None) -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (a strict total order)."""
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = salt_key if salt_key is not None else F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(key, F.lit(salts)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
