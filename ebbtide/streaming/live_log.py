"""The log as a stream: the batch functions, applied to rows as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampType

from ebbtide.config import DAY, HORIZON, ID, KIND, TIME, VOCABULARY, Vocabulary
from ebbtide.operators.activity import activity_filter, with_month
from ebbtide.operators.clean import LENIENT, CleaningProfile, clean_events, csv_missing_to_null


def raw_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """CSV files of a folder, all columns as text."""
    return (
        spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )


def live_activity(raw: DataFrame, profile: CleaningProfile = LENIENT, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Cleaned activity rows. Stateless."""
    return activity_filter(clean_events(csv_missing_to_null(raw), profile), vocabulary)


def store_by_month(activity: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to a dataset with a folder per month; each file is added exactly once."""
    dated = with_month(activity).withColumn(DAY, F.to_date(TIME))
    return (
        dated.writeStream.partitionBy("event_month").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).format("parquet").start(path)
    )


def appended(result: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what there is now and append what it closes to ``path``."""
    (
        result.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).format("parquet").start(path).awaitTermination()
    )


def delivered_once(activity: DataFrame, key: list[str], late_by: str = "2 days") -> DataFrame:
    """Drops events that a source delivers again within the watermark; state is kept that long only. The time column becomes an instant."""
    moments = _at_instants(activity, *[c for c in key if c not in (ID, KIND, TIME)])
    return moments.withWatermark(TIME, late_by).dropDuplicatesWithinWatermark(key)


def inactivity_spells(activity: DataFrame, days: int = HORIZON.inactive_flags[0], late_by: str = "2 days") -> DataFrame:
    """(customer, first_event, last_event, inactive_from, n_events) of each spell of activity that ``days`` days of silence end.

    A spell is a session window of the customer: its state holds a few numbers, and the watermark is the timer that emits the flag. In a batch
    all spells are given, in a stream those that the watermark has passed. Times are UTC without a zone.
    """
    moments = activity if isinstance(activity.schema[TIME].dataType, TimestampType) else _at_instants(activity)
    marked = moments.withWatermark(TIME, late_by) if moments.isStreaming and not _has_watermark(moments) else moments
    spells = marked.groupBy(F.session_window(TIME, f"{days} days").alias("spell"), ID).agg(
        F.min(TIME).alias("first"), F.max(TIME).alias("last"), F.count("*").alias("n_events")
    )
    zone_free = lambda c: F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return spells.select(
        ID, zone_free("first").alias("first_event"), zone_free("last").alias("last_event"), zone_free("spell.end").alias("inactive_from"), "n_events"
    )


def _has_watermark(df: DataFrame) -> bool:
    return "EventTimeWatermark" in df._jdf.queryExecution().analyzed().toString()


def _at_instants(activity: DataFrame, *more: str) -> DataFrame:
    """Times without a zone are UTC; as instants they are cut into windows whatever the zone of the session."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(TIME)))
    return activity.select(ID, KIND, moment.alias(TIME), *more)


def _utc_day(moment: str) -> Column:
    number = F.floor(F.unix_micros(moment) / 86_400_000_000).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), number)


def daily_activity(activity: DataFrame, late_by: str = "2 days") -> DataFrame:
    """Events per customer and UTC day, closed when the watermark has passed the day."""
    counted = _at_instants(activity).withWatermark(TIME, late_by).groupBy(F.window(TIME, "1 day").alias("day"), ID).agg(F.count("*").alias("n_events"))
    return counted.select(_utc_day("day.start").alias("day"), ID, "n_events")


def sliding_activity(activity: DataFrame, days: int = HORIZON.windows[0], late_by: str = "2 days") -> DataFrame:
    """Events per customer in the ``days`` UTC days up to and with each day, for the days on which a customer has any.

    Each row lies in ``days`` windows, so a task first adds up the rows of its own part.
    """
    window = F.window(TIME, f"{days} days", "1 day").alias("span")
    counted = _at_instants(activity).withWatermark(TIME, late_by).groupBy(window, ID).agg(F.count("*").alias("n_events"))
    return counted.select(F.date_sub(_utc_day("span.end"), 1).alias("last_day"), ID, "n_events")
