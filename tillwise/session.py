"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import SparkSession

# Settings every job relies on: UTC for date arithmetic parity, AQE for
# runtime coalescing / skew-join splitting, no UI server.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files go once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tillwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    that has none (tests) gets a private folder; elsewhere a missing setting is
    an error, as executors would write to separate disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_checkpoint(df):
    """``reliable_checkpoint`` for loops that join their own results. A checkpoint keeps
    the estimate of its plan, and that of a join is the product of its sides: over
    rounds its digits multiply until they alone fill the driver. Rows that were
    stored first are planned by the size they have."""
    stored = df.persist(StorageLevel.DISK_ONLY)
    try:
        stored.count()
        return reliable_checkpoint(stored)
    finally:
        stored.unpersist()


@contextmanager
def unused_shuffles_removed(spark: SparkSession, every: float = 20.0):
    """For a long job of many rounds: Spark removes shuffle files once the driver's garbage
    collector finds that nothing refers to them, by itself every 30 minutes or when its heap is
    full. Here it looks every so many seconds."""
    done, collect = threading.Event(), spark.sparkContext._jvm.System.gc

    def look():
        while not done.wait(every):
            collect()

    looking = threading.Thread(target=look, daemon=True)
    looking.start()
    try:
        yield
    finally:
        done.set()
        looking.join()
