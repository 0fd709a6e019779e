"""Streaming forms equal the batch forms on the same rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillwise.operators import activity as act
from tillwise.sources.fixtures import fx_activity
from tillwise.streaming.activity import start_daily_active_users, start_weekly_alerts

from settings import SF_SMALL


def test_streaming_dau_matches_batch(spark):
    q = start_daily_active_users(spark, SF_SMALL, "dau_stream_test", memory=True)
    q.awaitTermination(300)
    got = {r.day: r.dau for r in spark.sql("select * from dau_stream_test").collect()}
    want = {r.day: r.dau for r in act.dau(fx_activity(spark, SF_SMALL)).collect()}
    # the last day stays open until a later event moves the watermark past it
    assert got and all(want[d] == n for d, n in got.items())
    assert len(got) >= len(want) - 3


SKU_DAY = "date date, sku long, category string, price double, stock long, forecast_gmv double, actual_units long"
THRESHOLDS = {"supply": {"lost_sales_gmv_week_min": 2000}, "model": {"wape_delta": 0.05}, "data": {"max_price": 90}}


def sku_days():
    """Five weeks: a loss that only a whole week's rows reach, a week below it, one with an extreme price, one with neither."""
    rng = random.Random(6)
    monday = datetime.date(2024, 1, 1)
    rows = []
    for w, (units, price) in enumerate([(30, 10.0), (12, 10.0), (12, 95.0), (10, 5.0), (40, 10.0)]):
        for d in range(7):
            rows += [(monday + datetime.timedelta(7 * w + d), sku, "c", price, 10, units * price, rng.randrange(20)) for sku in range(2)]
    return rows


@pytest.mark.parametrize("files", [1, 5, 23])
def test_weekly_alerts_do_not_depend_on_the_batches(spark, tmp_path, files):
    from tillwise.operators import governance as gov
    rows = sku_days()
    source, out = tmp_path / "in", tmp_path / "out"
    last = (datetime.date(2024, 3, 1), 0, "c", 1.0, 10, 1.0, 1)  # closes all weeks before
    size = -(-len(rows) // files)
    for k, part in enumerate([rows[i:i + size] for i in range(0, len(rows), size)] + [[last], [last]]):
        spark.createDataFrame(part, SKU_DAY).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(SKU_DAY).option("maxFilesPerTrigger", 1).parquet(str(source))
    start_weekly_alerts(stream, f"weekly_alerts_{files}", str(out), THRESHOLDS).awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(str(out)).select("week", "level", "type", "message").collect())
    daily = gov.enrich(gov.coerce_types(spark.createDataFrame(rows, SKU_DAY))).withColumn("week", F.to_date(F.date_trunc("week", "date")))
    want = []
    for w in sorted({r.week for r in daily.select("week").distinct().collect()}):
        want += [(w, r.level, r.type, r.message) for r in gov.alerts(daily.where(F.col("week") == F.lit(w)), THRESHOLDS).collect()]
    assert got == sorted(want)
    assert {(w.isoformat(), t) for w, _, t, _ in got} >= {("2024-01-01", "SUPPLY"), ("2024-01-15", "DATA"), ("2024-01-29", "SUPPLY")}
    # no single day's rows reach the threshold that the week does
    assert not any(r.type == "SUPPLY" for d in daily.select("date").distinct().collect() for r in gov.alerts(daily.where(F.col("date") == F.lit(d.date)), THRESHOLDS).collect())
