"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session that has none gets a temporary folder of its own; on a
    cluster a missing setting is an error, as executors would write to separate disks.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so that a lost executor costs no rerun of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``checkpointed`` for wide rows: a compressed table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does just that where a text has no byte beyond ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def texts(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, whose rows hold whole texts, in small Arrow batches from now on.

    The default of 10,000 rows a batch makes buffers of tens of MB for texts, on both
    sides of the pipe to Python and for each task; this caps the session's setting.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``limit`` bytes of ``text`` (one row at least).

    No row is dropped or cut; this only bounds what Python holds at a time.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = [len(s.as_buffer()) if s.is_valid else 0 for s in batch.column(text)]
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for own columns that ``df`` does not have, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def one_row_each(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One row of each group of ``keys``, that of least text; the keys go."""
    others = [c for c in df.columns if c not in keys]
    [name] = fresh(df, "__row")
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.coalesce(text_col, F.lit("")))
    return df.groupBy(*keys).agg(row.alias(name)).select(f"{name}.*")
