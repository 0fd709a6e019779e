"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups.

The hash (MD5 of the normalised text) and the bytes themselves form the grouping
key, so texts whose hashes collide still fall into separate classes. Copies are
combined before the shuffle: a text that a third of all rows share sends one row
per map task. Rows then find their class over narrow columns (id and digests); that
is a plain equi-join, whose large keys Spark splits.

Defined results: a null text counts as empty; a null id loses to any other id and is
kept only where the class has no id at all; in the classes, rows that repeat an id and its
text share their fate, but of those dropping copies keeps one; an empty table gives an empty result; texts of any length are
hashed and compared whole; in the classes, further columns of the input are neither read nor returned,
and dropping copies keeps them all, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import ascii_lower, checkpointed, fresh, one_row_each


def exact_classes(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                  normalise=ascii_lower) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    pick = F.min if keep == "smallest" else F.max
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("bytes"))
    keyed = texts.select("doc_id", "bytes", F.unhex(F.md5("bytes")).alias("hash128"))
    classes = (keyed.groupBy("hash128", "bytes")
               .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("hash128", F.sha2("bytes", 256).alias("text_sha256"), "keep_id", "group_size"))
    rows = keyed.select("doc_id", "hash128", F.sha2("bytes", 256).alias("text_sha256"))
    return (rows.join(classes, ["hash128", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def drop_exact_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class; all columns stay."""
    own, sha_, n = fresh(docs, "__id", "__sha", "__n")
    kept = checkpointed(exact_classes(docs, keep, id_col, text_col).where("kept")
                        .groupBy(F.col("doc_id").alias(own), F.col("text_sha256").alias(sha_)).agg(F.count(F.lit(1)).alias(n)))
    sha = F.sha2(ascii_lower(F.coalesce(docs[text_col], F.lit(""))), 256)
    same = docs[id_col].eqNullSafe(F.col(own)) & (sha == F.col(sha_))
    several = kept.where(F.col(n) > 1)
    if several.isEmpty():
        return docs.join(kept, same, "left_semi")
    single = docs.join(kept.where(F.col(n) == 1), same, "left_semi")
    return single.unionByName(one_row_each(docs.join(several.drop(n), same), [own, sha_], text_col))
