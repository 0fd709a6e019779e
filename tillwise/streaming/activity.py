"""Structured Streaming forms of daily distinct users (D5) and of the
governance alerts (M5), for incremental inputs.

The reference has no streaming operator; these run the same logic on
micro-batches: event-time watermark, de-duplication of (user, day) inside the
watermark and a daily window count in append mode; for the alerts, running totals
of each week, judged when the week closes. State and offsets live under the shared
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators import governance as gov
from tillwise.session import checkpoint_dir

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_events_stream(spark: SparkSession, directory: str, file_glob: str = "events*.parquet",
                       max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files).parquet(directory))


def daily_active_users_stream(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Streaming D5: distinct users per event day, emitted once the watermark
    passes the end of the day."""
    e = events.select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    e = e.withColumn("day", F.to_date("ts")).withWatermark("ts", lateness)
    e = e.dropDuplicatesWithinWatermark(["user_id", "day"])
    return (e.groupBy(F.window("ts", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("dau"))
            .select(F.to_date(F.col("w.start")).alias("day"), "dau"))


def start_daily_active_users(spark: SparkSession, directory: str, name: str, table: str | None = None,
                             available_now: bool = True, memory: bool = False):
    """Run the streaming D5 into a parquet folder (by default one in the shared
    folder); ``memory`` keeps all output on the driver, for tests only."""
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    q = daily_active_users_stream(read_events_stream(spark, directory)).writeStream.outputMode("append") \
        .option("checkpointLocation", ckpt)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    if memory:
        return q.format("memory").queryName(name).start()
    return q.format("parquet").option("path", table or os.path.join(checkpoint_dir(spark), "streams-out", name)).start()


#: Windows start at the epoch, a Thursday; weeks start four days later.
MONDAY = "4 days"


def weekly_alerts_stream(rows: DataFrame, thresholds: dict | None = None, lateness: str = "2 days") -> DataFrame:
    """Streaming M5: the alerts of each Monday week, on the totals of the whole week.

    ``rows``: the streaming SKU-day table. State holds the running totals of the open weeks only
    (a few sums for each). A week is judged once, when the watermark (latest day seen less
    ``lateness``) has passed its end, so how rows are split into batches does not matter; rows that
    come after that are dropped."""
    daily = gov.enrich(gov.coerce_types(rows)).withColumn("ts", F.col("date").cast("timestamp"))
    week = F.window(F.col("ts"), "7 days", "7 days", MONDAY).alias("week")
    return (gov.alerts(daily.withWatermark("ts", lateness), thresholds, by=[week])
            .withColumn("week", F.to_date(F.col("week.start"))))


def start_weekly_alerts(rows: DataFrame, name: str, out_dir: str, thresholds: dict | None = None,
                        lateness: str = "2 days", available_now: bool = True):
    """Append the alerts of each closed week to parquet files in ``out_dir``; each week's are written exactly once."""
    q = (weekly_alerts_stream(rows, thresholds, lateness).writeStream.outputMode("append").format("parquet")
         .option("path", out_dir).option("checkpointLocation", os.path.join(checkpoint_dir(rows.sparkSession), "streams", name)))
    return (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")).start()
