"""Running sums in one global order, without a single-partition window.

``sum(x) over (order by k)`` with no ``partitionBy`` moves every row into one
task. Here the rows are range-partitioned on the order key, the range
assignment is checkpointed (so retries and both uses see the same split),
per-range totals (one row per range, a proven size bound) give each range its
offset, and the running sum inside a range is an ordinary partitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import reliable_checkpoint

PID = "_range_id"


def ordered_prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column],
                        row_number: str | None = None,
                        ranges: int | None = None) -> DataFrame:
    """Add inclusive running sums ``{name: expr}`` in the total order ``order``.

    ``order`` must be a strict total order (callers add a unique tie-break).
    ``row_number`` optionally adds the 1-based global position.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vals = df.select("*", *[e.alias(f"_v_{k}") for k, e in sums.items()])
    if row_number:
        vals = vals.withColumn("_v__rn", F.lit(1).cast("long"))
    ranged = vals.repartitionByRange(n, *order).withColumn(PID, F.spark_partition_id())
    ranged = reliable_checkpoint(ranged)
    vcols = [c for c in ranged.columns if c.startswith("_v_")]
    totals = ranged.groupBy(PID).agg(*[F.sum(c).alias(c) for c in vcols])
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(PID, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias("_o" + c)
                                   for c in vcols])
    inside = Window.partitionBy(PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), PID)
    names = [(k, f"_v_{k}") for k in sums] + ([(row_number, "_v__rn")] if row_number else [])
    for name, v in names:
        out = out.withColumn(name, F.col("_o" + v) + F.sum(v).over(inside))
    return out.drop(PID, *vcols, *["_o" + v for v in vcols])


def keyed_sequence(df: DataFrame, key: str, order: list[str], prev_cols: list[str],
                   sums: dict[str, Column] | None = None, ranges: int | None = None) -> DataFrame:
    """Per-key ``lag(col)`` and inclusive running sums in ``order`` that stay
    exact when one key spans many range partitions.

    ``partitionBy(key)`` would put a key holding a third of the rows in one
    task. Here rows are range-partitioned on (key, order) and checkpointed;
    each range receives the last row of the previous range (one row per
    range) for the lag, and per-(range, key) totals (one row per range and
    key, each key spanning at most ``ranges`` rows) give running-sum offsets.
    ``order`` must make (key, order) unique. ``sums`` may reference
    ``prev_<col>``.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, F.col(key), *[F.col(c) for c in order]).withColumn(PID, F.spark_partition_id())
    r = reliable_checkpoint(r)
    ordered = Window.orderBy(PID)
    last = r.groupBy(PID).agg(F.max_by(F.struct(F.col(key).alias("k"), *[F.col(c) for c in prev_cols]),
                                       F.struct(F.col(key), *[F.col(c) for c in order])).alias("_last"))
    carry = last.select(PID, F.lag("_last").over(ordered).alias("_carry"))
    inside = Window.partitionBy(PID, key).orderBy(*order)
    x = r.join(F.broadcast(carry), PID)
    same = F.col("_carry.k") == F.col(key)
    for c in prev_cols:
        x = x.withColumn(f"prev_{c}", F.coalesce(F.lag(c).over(inside),
                                                 F.when(F.row_number().over(inside) == 1, F.when(same, F.col(f"_carry.{c}")))))
    x = x.drop("_carry")
    if not sums:
        return x.drop(PID)
    for name, e in sums.items():
        x = x.withColumn(f"_v_{name}", e)
    x = reliable_checkpoint(x)
    tot = x.groupBy(PID, key).agg(*[F.sum(f"_v_{n_}").alias(f"_t_{n_}") for n_ in sums])
    before = Window.partitionBy(key).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(PID, key, *[F.coalesce(F.sum(f"_t_{n_}").over(before), F.lit(0)).alias(f"_o_{n_}")
                                 for n_ in sums])
    x = x.join(off, [PID, key])
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    for name in sums:
        x = x.withColumn(name, F.col(f"_o_{name}") + F.sum(f"_v_{name}").over(run))
    return x.drop(PID, *[f"_v_{n_}" for n_ in sums], *[f"_o_{n_}" for n_ in sums])
