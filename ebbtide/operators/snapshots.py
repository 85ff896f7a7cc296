"""Snapshot calendars, labels and the pooled training set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import HORIZON, ID, SNAPSHOT, TIME, VOCABULARY, Horizon, Vocabulary
from ebbtide.functions.clock import days, instant, month_key, utc_naive
from ebbtide.operators.features import STEP, feature_names, snapshot_features


def time_range(log: DataFrame) -> DataFrame:
    """First and last event: one row."""
    return log.agg(F.min(TIME).alias("first_event"), F.max(TIME).alias("last_event"))


def observed_range(log: DataFrame) -> tuple[datetime, datetime]:
    """The two instants, as plan literals for whatever follows."""
    row = time_range(log).first()
    if row is None or row["last_event"] is None:
        raise ValueError("the log holds no events")
    return row["first_event"], row["last_event"]


@dataclass(frozen=True)
class SnapshotCalendar:
    """Snapshot k lies k steps before the anchor; snapshots 1 to ``pooled`` are for training."""

    anchor: datetime
    pooled: int
    first_event: datetime
    last_event: datetime


def calendar_between(first_event: datetime, last_event: datetime, horizon: Horizon = HORIZON,
                     limit: int = 0) -> SnapshotCalendar:
    """All snapshots that have a whole lookback behind them and a whole outcome window ahead."""
    first_event, last_event = utc_naive(first_event), utc_naive(last_event)
    anchor = last_event - timedelta(days=horizon.outcome)
    room = anchor - first_event - timedelta(days=horizon.lookback)
    pooled = max(room // timedelta(days=horizon.step), 0)
    if limit > 0:
        pooled = min(pooled, limit)
    return SnapshotCalendar(anchor, pooled, first_event, last_event)


def calendar_of(log: DataFrame, horizon: Horizon = HORIZON, limit: int = 0) -> SnapshotCalendar:
    return calendar_between(*observed_range(log), horizon, limit)


def snapshot_calendar(log: DataFrame, horizon: Horizon = HORIZON, limit: int = 0) -> DataFrame:
    """The calendar as rows: index, time, start of the lookback, end of the outcome window."""
    day_micros = 86_400_000_000
    bounds = time_range(log).select(
        (F.col("last_event") - days(horizon.outcome)).alias("anchor"),
        F.timestamp_diff("MICROSECOND", F.col("first_event"), F.col("last_event")).alias("span"),
    )
    room = F.col("span") - (horizon.outcome + horizon.lookback) * day_micros
    count = F.greatest(F.floor(room / (horizon.step * day_micros)), F.lit(0)).cast("int")
    if limit > 0:
        count = F.least(count, F.lit(limit))
    time = F.col("anchor") - days(F.col(STEP) * horizon.step)
    return bounds.select("anchor", F.explode(F.sequence(F.lit(0), count)).alias(STEP)).select(
        STEP,
        time.alias(SNAPSHOT),
        (time - days(horizon.lookback)).alias("lookback_start"),
        (time + days(horizon.outcome)).alias("outcome_end"),
    )


def months_in_range(bounds: DataFrame) -> DataFrame:
    """Calendar months touched from ``first_event`` to ``last_event``, one row each."""
    months = F.sequence(
        F.trunc(F.to_date("first_event"), "MM"), F.trunc(F.to_date("last_event"), "MM"), F.expr("INTERVAL 1 MONTH")
    )
    return bounds.select(F.explode(months).alias("month_start")).select(
        month_key(F.col("month_start").cast("timestamp_ntz")).alias("event_month")
    )


def labelled_snapshot(log: DataFrame, snapshot: datetime, horizon: Horizon = HORIZON,
                      vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Features and label of every customer seen in the lookback of one snapshot."""
    rows = snapshot_features(log, snapshot, horizon, vocabulary)
    return rows.select(ID, *feature_names(horizon, vocabulary), horizon.target)


def labelled_counts(log: DataFrame, snapshot: datetime, horizon: Horizon = HORIZON,
                    vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Features of everyone ever seen up to the snapshot, with the count behind the label."""
    rows = snapshot_features(log, snapshot, horizon, vocabulary, history="full")
    return rows.select(
        ID,
        *feature_names(horizon, vocabulary),
        horizon.future_count,
        horizon.target,
        SNAPSHOT,
        instant(snapshot + timedelta(days=horizon.outcome)).alias("window_end"),
    )


def inactivity_labels(log: DataFrame, snapshot: datetime, horizon: Horizon = HORIZON) -> DataFrame:
    """The label alone: 1 for a customer seen in the lookback and not in the outcome window."""
    time, now = F.col(TIME), instant(snapshot)
    return (
        log.filter((time > now - days(horizon.lookback)) & (time <= now + days(horizon.outcome)))
        .groupBy(ID)
        .agg(F.count_if(time <= now).alias("past"), F.count_if(time > now).alias("future"))
        .filter("past > 0")
        .select(ID, (F.col("future") == 0).cast("int").alias(horizon.target))
    )


def pooled_snapshots(log: DataFrame, calendar: SnapshotCalendar, horizon: Horizon = HORIZON,
                     vocabulary: Vocabulary = VOCABULARY, first_step: int = 1,
                     last_step: int | None = None) -> DataFrame:
    """Labelled snapshots of a calendar in one table; step 0 is the hold-out snapshot."""
    last_step = calendar.pooled if last_step is None else min(last_step, calendar.pooled)
    if last_step < first_step:
        raise ValueError("no snapshot has enough history for pooled training")
    rows = snapshot_features(log, calendar.anchor, horizon, vocabulary, first_step, last_step)
    return rows.select(STEP, SNAPSHOT, ID, *feature_names(horizon, vocabulary), horizon.target)


def snapshot_summary(pooled: DataFrame, target: str = HORIZON.target) -> DataFrame:
    """Rows and share of inactive customers of each snapshot, newest first."""
    return (
        pooled.groupBy(STEP, SNAPSHOT)
        .agg(F.count("*").alias("n_rows"), F.avg(target).alias("churn_rate"))
        .orderBy(STEP)
    )


def class_weights(rows: DataFrame, target: str = HORIZON.target) -> DataFrame:
    """Balanced weights: all rows over twice the rows of the class."""
    per_class = rows.groupBy(target).agg(F.count("*").alias("n_rows"))
    both = Window.partitionBy(F.lit(1))
    even_share = F.sum("n_rows").over(both) / F.count("*").over(both)
    return per_class.select(target, "n_rows", (even_share / F.col("n_rows")).alias("weight"))
