"""A stream of files gives what the batch functions give."""

from __future__ import annotations

from conftest import SMALL
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, TIME
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.clean import clean_events
from ebbtide.sources import sample_logs as logs
from ebbtide.sources.readers import read_raw_csv
from ebbtide.sources.sinks import write_csv
from ebbtide.streaming.live_log import daily_activity, live_activity, raw_stream, sliding_activity, store_by_month


def test_stream_equals_batch(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    write_csv(logs.raw_text_log(spark, SMALL).repartition(3), raw)
    batch = activity_filter(clean_events(read_raw_csv(spark, raw)))
    schema = spark.read.option("header", True).csv(raw).schema
    live = live_activity(raw_stream(spark, raw, schema, files_per_batch=1))
    store_by_month(live, f"{tmp_path}/store", f"{tmp_path}/progress").awaitTermination()
    core = [ID, TIME, KIND]
    stored = spark.read.parquet(f"{tmp_path}/store")
    assert sorted(map(tuple, stored.select(*core).collect())) == sorted(map(tuple, batch.select(*core).collect()))


def test_daily_counts_equal_batch(spark, tmp_path):
    """In the zone of the suite, which is not UTC."""
    log = activity_filter(logs.short_log(spark, SMALL))
    log.write.parquet(f"{tmp_path}/log")
    live = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    query = (
        daily_activity(live).writeStream.outputMode("complete").format("memory").queryName("daily")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    wanted = log.groupBy(F.to_date(TIME).alias("day"), ID).agg(F.count("*").alias("n_events"))
    got = spark.table("daily").select("day", ID, "n_events")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_sliding_counts_equal_batch(spark, tmp_path):
    log = activity_filter(logs.short_log(spark, SMALL))
    log.write.parquet(f"{tmp_path}/log")
    live = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    query = (
        sliding_activity(live, 5).writeStream.outputMode("complete").format("memory").queryName("sliding")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("ahead")
    wanted = log.select(F.to_date(TIME).alias("day"), ID, ahead).groupBy(F.expr("date_add(day, ahead)").alias("last_day"), ID)
    got = spark.table("sliding").select("last_day", ID, "n_events")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.agg(F.count("*").alias("n_events")).collect()))
