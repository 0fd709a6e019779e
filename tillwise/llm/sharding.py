"""Byte-bounded shards by extendible hashing, in DataFrame operations only.

A row's address is a string of bits: 60 of the hash of its key, then 60 of the hash
of its content (so rows that share one key can still be told apart). A shard is a
prefix of that address. The directory starts at the empty prefix, and only a prefix
whose rows exceed the byte limit is split on the next bit.

Sums are kept per prefix of ``depth`` bits (some 256 prefixes for each shard, made
by partial aggregation), and the split is decided on these sums alone. Prefixes of
that depth that are still too large go on to a next round with 16 more bits, over
their own rows only; most inputs need one round.

Defined results: a null key and a null text count as empty; a row larger than the
limit gets a shard of its own, and rows equal in key and content, which no bit can
separate, share one: both are marked ``oversize``. Texts of any length are hashed whole. An empty
table gives no shard; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import checkpointed, fresh

ADDRESS_BITS = 120
NEXT_BITS = 16


def _bits(digest: Column) -> Column:
    return F.lpad(F.bin(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")), 60, "0")


def address(key: Column, text: Column) -> Column:
    return F.concat(_bits(F.md5(F.coalesce(key.cast("string"), F.lit("")))), _bits(F.md5(F.coalesce(text, F.lit("")))))


def addresses(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.select(rows[key].alias("doc_id"), address(rows[key], rows[text]).alias("address"),
                       F.octet_length(F.coalesce(rows[text], F.lit(""))).cast("bigint").alias("bytes"))


def extendible_shards(rows: DataFrame, limit: int, key: str = "doc_id", text: str = "text",
                      first_depth: int | None = None) -> DataFrame:
    """doc_id, bytes, shard (its bits), depth, shard_bytes, shard_rows, oversize for each row."""
    return _placed(rows, limit, key, text, first_depth).drop("address")


def _placed(rows: DataFrame, limit: int, key: str, text: str, first_depth: int | None = None) -> DataFrame:
    if limit < 1:
        raise ValueError("limit must be positive")
    pending = addresses(rows, key, text)
    if first_depth is None:
        total = pending.agg(F.sum("bytes")).first()[0] or 0
        first_depth = max(8, math.ceil(math.log2(max(1, total / limit))) + 8)
    depth, lowest, out = min(ADDRESS_BITS, first_depth), 0, None
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    while True:
        last = depth == ADDRESS_BITS
        fine = checkpointed(pending.groupBy(F.substring("address", 1, depth).alias("prefix"))
                            .agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")))
        paths = fine.select("prefix", "b", "n", F.explode(F.sequence(F.lit(lowest), F.lit(depth))).alias("depth")) \
            .withColumn("shard", F.expr("substring(prefix, 1, depth)"))
        nodes = paths.groupBy("shard", "depth").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        leaves = nodes.where(fits | F.lit(last) & (F.col("depth") == ADDRESS_BITS))
        directory = (paths.select("prefix", "shard").join(leaves, "shard").groupBy("prefix")
                     .agg(F.min(F.struct("depth", "shard", "shard_bytes", "shard_rows")).alias("leaf")))
        placed = (pending.withColumn("prefix", F.substring("address", 1, depth)).join(directory, "prefix")
                  .select("doc_id", "address", "bytes", "leaf.shard", "leaf.depth", "leaf.shard_bytes", "leaf.shard_rows",
                          (F.col("leaf.shard_bytes") > limit).alias("oversize")))
        out = placed if out is None else out.unionByName(placed)
        too_large = fine.where((F.col("b") > limit) & (F.col("n") > 1)).select("prefix")
        if last or too_large.isEmpty():
            return out
        pending = checkpointed(pending.withColumn("prefix", F.substring("address", 1, depth))
                               .join(too_large, "prefix", "left_semi").drop("prefix"))
        lowest, depth = depth + 1, min(ADDRESS_BITS, depth + NEXT_BITS)


def write_shards(rows: DataFrame, limit: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write ``rows``, all columns, with one folder per shard; a shard is bounded, so one task writes it.

    Rows find their shard by address, which rows equal in key and content share: null and repeated
    keys included, each row is written once. The folders are named by a column ``shard`` that the
    input may not have."""
    if "shard" in [c.lower() for c in rows.columns]:
        raise ValueError("rename the column shard: it names the folders")
    [mine] = fresh(rows, "__address")
    where = _placed(rows, limit, key, text).groupBy(F.col("address").alias(mine)).agg(F.concat(F.lit("b"), F.first("shard")).alias("shard"))
    placed = rows.withColumn(mine, address(rows[key], rows[text])).join(where, mine).drop(mine)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
