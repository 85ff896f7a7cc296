"""Daily tallies per customer, stored by month: features at any snapshot without another pass over the log.

A row says how often a customer had events of one kind in one part of one date; the parts are divided by the time of day at which
snapshots are taken, which is fixed for a store. Months that new days or late events belong to are tallied anew from the log and
replace the month's folder, so bringing a store up to date reads those months only, and doing it twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import DAY, HORIZON, ID, KIND, MONTH, SNAPSHOT, TIME, VOCABULARY, Horizon, Vocabulary
from ebbtide.functions.clock import month_key, utc_naive
from ebbtide.operators.features import LATE, OFFSET, STEP, event_tallies, feature_names, features_of_tallies, folded_tallies
from ebbtide.sources.readers import require_path
from ebbtide.sources.sinks import write_json

TALLY = (ID, DAY, LATE, KIND, "n")


def _dated_tallies(log: DataFrame, cut: time, vocabulary: Vocabulary) -> DataFrame:
    """Tallies with their date. Any instant at the store's time of day divides the dates in the same way."""
    anchor = datetime.combine(date(2000, 1, 1), cut)
    tallies = event_tallies(log, anchor, vocabulary=vocabulary)
    day = F.date_sub(F.lit(anchor.date()), F.col(OFFSET))
    return tallies.withColumn(DAY, day).select(*TALLY, month_key(F.col(DAY)).alias(MONTH))


def _write(tallies: DataFrame, folder: str, mode: str) -> None:
    writer = tallies.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, DAY, ID).write.mode("overwrite")
    writer.option("partitionOverwriteMode", mode).partitionBy(MONTH).parquet(f"{folder}/tallies")


def build_store(log: DataFrame, folder: str, cut: time, vocabulary: Vocabulary = VOCABULARY) -> None:
    """A store of the whole log for snapshots at the time of day ``cut``."""
    record = log.sparkSession.range(1).select(F.lit(cut.isoformat()).alias("cut"))
    write_json(record, f"{folder}/settings")
    _write(_dated_tallies(log, cut, vocabulary), folder, "static")


def _cut_of(spark: SparkSession, folder: str) -> time:
    path = require_path(spark, f"{folder}/settings", "build the store first")
    return time.fromisoformat(spark.read.schema("cut string").json(path).first()["cut"])


def dates_of(log: DataFrame) -> list[date]:
    """The dates that a batch of new events belongs to."""
    return sorted(r["d"] for r in log.select(F.to_date(TIME).alias("d")).dropna().distinct().collect())


def changed_months(dates: Iterable[date]) -> list[str]:
    """The months that a batch touches, as ``yyyy-MM``."""
    return sorted({d.strftime("%Y-%m") for d in dates})


def events_in(log: DataFrame, months: Iterable[str]) -> DataFrame:
    """Rows of the given months; tables by month are read for those only."""
    wanted = sorted(months)
    test = month_key(F.col(TIME)).isin(*wanted)
    return log.where(F.col(MONTH).isin(*wanted) & test if MONTH in log.columns else test)


def refresh_months(log: DataFrame, folder: str, months: Iterable[str], vocabulary: Vocabulary = VOCABULARY) -> None:
    """Tally the given months anew from the log, which holds all their events by now; the store's other months are not touched."""
    spark, wanted = log.sparkSession, sorted(months)
    cut = _cut_of(spark, folder)
    if not wanted:
        return
    events = events_in(log, wanted)
    _write(_dated_tallies(events, cut, vocabulary), folder, "dynamic")
    # A month without events any more has no rows that could replace it.
    left = {r["m"] for r in events.select(month_key(F.col(TIME)).alias("m")).distinct().collect()}
    for gone in set(wanted) - left:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/tallies/{MONTH}={gone}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark.catalog.refreshByPath(f"{folder}/tallies")


def _tallies(spark: SparkSession, folder: str, anchor: datetime, youngest: int, oldest: int | None) -> DataFrame:
    """Stored tallies of the ages from ``youngest`` to below ``oldest``, with their offset from the anchor."""
    cut = _cut_of(spark, folder)
    if anchor.time() != cut:
        raise ValueError(f"the store is for snapshots at {cut}, not {anchor.time()}")
    # The folders' names are text, whatever they look like.
    schema = spark.read.parquet(f"{folder}/tallies").drop(MONTH).schema.add(MONTH, "string")
    stored = spark.read.schema(schema).parquet(f"{folder}/tallies")
    offset = F.datediff(F.lit(anchor.date()), F.col(DAY))
    # The late part of a date is a day younger than its early part, so one more date is read.
    last = anchor.date() - timedelta(days=youngest)
    dates = (F.col(DAY) <= F.lit(last)) & (F.col(MONTH) <= last.strftime("%Y-%m"))
    if oldest is not None:
        first = anchor.date() - timedelta(days=oldest)
        dates = dates & (F.col(DAY) >= F.lit(first)) & (F.col(MONTH) >= first.strftime("%Y-%m"))
    rows = stored.where(dates).select(*TALLY, offset.alias(OFFSET))
    age = F.col(OFFSET) - F.col(LATE).cast("int")
    return rows.where(age >= youngest) if oldest is None else rows.where((age >= youngest) & (age < oldest))


def _together(tallies: DataFrame) -> DataFrame:
    return tallies.repartition(int(tallies.sparkSession.conf.get("spark.sql.shuffle.partitions")), ID)


def stored_features(spark: SparkSession, folder: str, snapshot: datetime, horizon: Horizon = HORIZON,
                    vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """What ``customer_features`` gives for the log behind the store."""
    snapshot = utc_naive(snapshot)
    tallies = folded_tallies(_tallies(spark, folder, snapshot, 0, None), horizon)
    features = features_of_tallies(_together(tallies), snapshot, horizon, vocabulary, 0, 0, True)
    return features.select(ID, *feature_names(horizon, vocabulary))


def stored_snapshots(spark: SparkSession, folder: str, anchor: datetime, first_step: int, last_step: int, horizon: Horizon = HORIZON,
                     vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """What ``pooled_snapshots`` gives for the log behind the store."""
    anchor = utc_naive(anchor)
    tallies = _tallies(spark, folder, anchor, first_step * horizon.step - horizon.outcome, last_step * horizon.step + horizon.lookback)
    rows = features_of_tallies(_together(tallies), anchor, horizon, vocabulary, first_step, last_step, False)
    return rows.select(STEP, SNAPSHOT, ID, *feature_names(horizon, vocabulary), horizon.target)

