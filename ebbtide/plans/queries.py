"""Every registered query: what it computes over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import (
    BUCKET, EVALUATED_SNAPSHOTS, HORIZON, ID, KIND, MONTH, PERCENTILE_BOUNDS, PROBABILITY, REQUIRED, SNAPSHOT, TIME,
    BoostedSettings, Horizon,
)
from ebbtide.functions.clock import day_order, instant
from ebbtide.models.importance import boosted_importance, boosted_splits, linear_importance
from ebbtide.models.leafwise import LeafwiseModel
from ebbtide.operators import features as feat
from ebbtide.operators import snapshots as snap
from ebbtide.operators.activity import activity_filter, counts_with_share, is_activity, month_partitions, with_month
from ebbtide.operators.clean import BAD_TIME, CLEAN, EITHER_ORDER, NO_TIME, STRICT, clean_events, csv_missing_to_null, flagged_events
from ebbtide.operators.features import STEP, customer_features, feature_names
from ebbtide.operators.matrix import column_spread, feature_matrix
from ebbtide.operators.metrics import (
    average_precision, best_threshold, classification_metrics, ranked_scores, roc_auc, rolling_evaluation,
    threshold_table,
)
from ebbtide.operators.quality import log_quality
from ebbtide.operators.ranking import quantile_sketches, sketched_quantiles
from ebbtide.operators.sampling import events_of, extract_recent, sampled_customers
from ebbtide.operators.scoring import (
    bucket_distribution, recency_distribution, score_table, weak_signal, with_buckets,
)
from ebbtide.operators.snapshots import SnapshotCalendar
from ebbtide.plans import training
from ebbtide.plans.scoring_run import percentile_scores
from ebbtide.session import scratch_folder
from ebbtide.sources import sample_logs as logs
from ebbtide.sources.activity_store import load_events, replace_months, window_of, write_by_month
from ebbtide.sources.customer_store import write_by_customer
from ebbtide.sources.readers import MALFORMED, quarantine, read_checked_csv, whole_rows
from ebbtide.sources.sinks import write_csv
from ebbtide.sources.tally_store import build_store, changed_months, dates_of, refresh_months, stored_features, stored_snapshots
from ebbtide.streaming.live_log import appended, daily_activity, delivered_once, inactivity_spells, live_activity, sliding_activity

Query = Callable[[SparkSession, str], DataFrame]

SHORT = Horizon(windows=(3, 6, 9), lookback=9, outcome=1, step=3, inactive_flags=(1, 2))
SAMPLE = 100
SCORES_PER_RANGE = 5_000
EXTRACT_AS_OF = date(2001, 8, 1)
REPLACED = (date(1998, 6, 1), date(1998, 6, 30))
#: What a tally store learns late, beside the orders of ``REPLACED``: the last days of the log.
NEW_DAYS = 45
BUCKETS = 16

_REGISTRY: dict[str, Query] = {}


def registered(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _REGISTRY[name] = query
        return query

    return add


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _activity(spark: SparkSession, folder: str) -> DataFrame:
    return activity_filter(logs.long_log(spark, folder))


def _short_activity(spark: SparkSession, folder: str) -> DataFrame:
    return activity_filter(logs.short_log(spark, folder))


def _latest(log: DataFrame):
    return snap.observed_range(log)[1]


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return csv_missing_to_null(logs.raw_text_log(spark, folder))


def _raw_score(lookback: int) -> Column:
    return 1 - F.col(f"active_days_last_{lookback}d") / (F.col("recency_days") + F.lit(10.0))


def stand_in_score(lookback: int) -> Column:
    """A score that any SQL engine can compute: few active days and a long silence mean risk.

    It has three decimals, so there are at most 1,001 distinct scores.
    """
    raw = _raw_score(lookback)
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)) * 1000) / F.lit(1000.0)


def _scored(features: DataFrame, lookback: int = HORIZON.lookback) -> DataFrame:
    return features.select(ID, stand_in_score(lookback).alias(PROBABILITY))


def _pooled(spark: SparkSession, folder: str, first_step: int, last_step: int | None = None):
    activity = _activity(spark, folder)
    calendar = snap.calendar_of(activity)
    return snap.pooled_snapshots(activity, calendar, first_step=first_step, last_step=last_step), calendar


def _rated(spark: SparkSession, folder: str, last_step: int | None = None) -> DataFrame:
    pooled, _ = _pooled(spark, folder, 0, last_step)
    return pooled.select(STEP, SNAPSHOT, HORIZON.target, stand_in_score(HORIZON.lookback).alias(PROBABILITY))


def _test_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    return snap.labelled_snapshot(activity, snap.calendar_of(activity).anchor)


def _latest_features(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    return customer_features(activity, _latest(activity))


# --- cleaning, filtering, accounting -------------------------------------------------


@registered("clean_events")
def clean_log(spark: SparkSession, folder: str) -> DataFrame:
    return clean_events(_raw(spark, folder))


@registered("clean_events_strict")
def clean_log_strict(spark: SparkSession, folder: str) -> DataFrame:
    return clean_events(_raw(spark, folder), STRICT, as_of=logs.RAW_AS_OF)


@registered("clean_day_first")
def clean_day_first(spark: SparkSession, folder: str) -> DataFrame:
    """A log that writes the day first, which the log itself shows: its ambiguous times are read the same way."""
    return clean_events(csv_missing_to_null(logs.day_first_text_log(spark, folder)), day_first=None)


@registered("day_order")
def day_order_report(spark: SparkSession, folder: str) -> DataFrame:
    return day_order(logs.day_first_text_log(spark, folder), TIME)


@registered("csv_round_trip")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log through a file, cleaned from the whole rows of a checked read."""
    path = f"{scratch_folder(spark, 'csv')}/raw.csv"
    write_csv(logs.raw_text_log(spark, folder), path)
    return clean_events(whole_rows(read_checked_csv(spark, path)))


@registered("quarantined_rows")
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with too many or too few cells, each with the number of times that it occurs."""
    path = scratch_folder(spark, "csv")
    logs.write_lines(logs.broken_log(spark, folder), f"{path}/broken.csv")
    return quarantine(read_checked_csv(spark, f"{path}/broken.csv"), f"{path}/quarantine").groupBy(MALFORMED).agg(F.count("*").alias("n_rows"))


@registered("unbroken_rows")
def unbroken_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_folder(spark, 'csv')}/broken.csv"
    logs.write_lines(logs.broken_log(spark, folder), path)
    return whole_rows(read_checked_csv(spark, path))


@registered("data_quality")
def data_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    flagged = flagged_events(_raw(spark, folder))
    core = [c for c in flagged.columns if c not in (CLEAN, NO_TIME, BAD_TIME, EITHER_ORDER)]
    active = F.col(CLEAN) & is_activity()
    names = {"clean": core, "activity": core, "month": [*REQUIRED, MONTH]}
    report = log_quality(flagged, {"clean": F.col(CLEAN), "activity": active, "month": active}, {k: ", ".join(v) for k, v in names.items()})
    return report.drop("null_times", "unparsed_times", "ambiguous_times")


@registered("time_range")
def time_range(spark: SparkSession, folder: str) -> DataFrame:
    return snap.time_range(_activity(spark, folder))


@registered("activity_filter")
def activity_events(spark: SparkSession, folder: str) -> DataFrame:
    return _activity(spark, folder)


@registered("event_counts")
def event_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts_with_share(_activity(spark, folder), KIND)


@registered("month_partitions")
def month_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    return month_partitions(_activity(spark, folder))


@registered("months_in_range")
def months_in_range(spark: SparkSession, folder: str) -> DataFrame:
    return snap.months_in_range(snap.time_range(_activity(spark, folder)))


@registered("load_events_window")
def load_events_window(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    anchor = snap.calendar_of(activity).anchor
    start, end = anchor - timedelta(days=HORIZON.lookback), anchor + timedelta(days=HORIZON.outcome)
    return window_of(with_month(activity), start, end)


def _stored_months(spark: SparkSession, folder: str) -> str:
    path = f"{scratch_folder(spark, 'months')}/log"
    write_by_month(_activity(spark, folder), path)
    return path


@registered("month_dataset_window")
def month_dataset_window(spark: SparkSession, folder: str) -> DataFrame:
    """The window of ``load_events_window``, read from a dataset by month."""
    path = _stored_months(spark, folder)
    anchor = snap.calendar_of(_activity(spark, folder)).anchor
    return load_events(spark, path, anchor - timedelta(days=HORIZON.lookback), anchor + timedelta(days=HORIZON.outcome))


@registered("replaced_month")
def replaced_month(spark: SparkSession, folder: str) -> DataFrame:
    """One month of the dataset is replaced by its orders; it and its neighbours are read back."""
    path = _stored_months(spark, folder)
    first, last = REPLACED
    changed = _activity(spark, folder).where((F.col(KIND) == "order") & (F.to_date(TIME) >= first) & (F.to_date(TIME) <= last))
    replace_months(changed, path)
    start = datetime.combine(first, time()) - timedelta(days=40)
    return load_events(spark, path, start, start + timedelta(days=100))


@registered("window_slice")
def window_slice(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    end = _latest(activity) - timedelta(days=SHORT.outcome)
    return window_of(activity, end - timedelta(days=SHORT.lookback), end)


@registered("extract_recent_incoming")
def extract_recent_incoming(spark: SparkSession, folder: str) -> DataFrame:
    return extract_recent(logs.interactions(spark, folder), "incoming_outgoing", EXTRACT_AS_OF)


@registered("sampled_customers")
def sampled_customer_ids(spark: SparkSession, folder: str) -> DataFrame:
    return sampled_customers(logs.long_log(spark, folder), SAMPLE)


@registered("sampled_customer_events")
def sampled_customer_events(spark: SparkSession, folder: str) -> DataFrame:
    log = logs.long_log(spark, folder)
    return events_of(log, sampled_customers(log, SAMPLE))


# --- features ------------------------------------------------------------------------


@registered("customer_recency")
def customer_recency(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    return feat.customer_recency(activity, _latest(activity))


def _columns(names: list[str]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _latest_features(spark, folder).select(ID, *names)

    return query


_MIX = [feat.count_column(kind, w) for w in HORIZON.windows for kind in feat.VOCABULARY.listed]
_REGISTRY["event_frequency"] = _columns([f"n_events_last_{w}d" for w in HORIZON.windows])
_REGISTRY["active_days"] = _columns([f"active_days_last_{w}d" for w in HORIZON.windows])
_REGISTRY["event_mix"] = _columns(_MIX)
_REGISTRY["trend_features"] = _columns(["freq_trend_30_60", "freq_trend_60_90", "active_ratio_30d"])
_REGISTRY["family_ratios"] = _columns([
    "n_session_events_last_30d", "n_email_engagement_last_30d", "n_orders_last_30d", "session_share_30d",
    "email_share_30d", "events_per_active_day_30d", "click_to_open_30d",
])
_REGISTRY["customer_features"] = _latest_features


@registered("customer_features_short")
def customer_features_short(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    snapshot = _latest(activity) - timedelta(days=SHORT.outcome)
    return customer_features(activity, snapshot, SHORT)


def _updated_store(spark: SparkSession, folder: str) -> tuple[str, SnapshotCalendar]:
    """A store that was built without the last days and without the orders of a month long ago, and then brought up to date."""
    activity = _activity(spark, folder)
    calendar = snap.calendar_of(activity)
    path = f"{scratch_folder(spark, 'tallies')}/store"
    new = F.col(TIME) > instant(calendar.last_event - timedelta(days=NEW_DAYS))
    late = (F.col(KIND) == "order") & (F.to_date(TIME) >= REPLACED[0]) & (F.to_date(TIME) <= REPLACED[1])
    build_store(activity.where(~(new | late)), path, calendar.anchor.time())
    refresh_months(activity, path, changed_months(dates_of(activity.where(new | late))))
    return path, calendar


@registered("incremental_features")
def incremental_features(spark: SparkSession, folder: str) -> DataFrame:
    """``customer_features`` from stored daily tallies that were updated by date."""
    path, calendar = _updated_store(spark, folder)
    return stored_features(spark, path, calendar.last_event)


@registered("incremental_snapshots")
def incremental_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """``pooled_snapshots`` from the same store."""
    path, calendar = _updated_store(spark, folder)
    return stored_snapshots(spark, path, calendar.anchor, 1, calendar.pooled)


@registered("bucketed_features")
def bucketed_features(spark: SparkSession, folder: str) -> DataFrame:
    """``customer_features`` from a table bucketed by customer, without a shuffle."""
    path = scratch_folder(spark, "bucketed")
    log = write_by_customer(_activity(spark, folder), path.rsplit("/", 1)[-1].replace("-", "_"), path, BUCKETS)
    return customer_features(log, _latest(log), together=True)


@registered("bucketed_weak_signal")
def bucketed_weak_signal(spark: SparkSession, folder: str) -> DataFrame:
    """``weak_signal`` of two tables bucketed by customer."""
    tables = {"known": logs.registered_customers(spark, folder), "active": _short_activity(spark, folder)}
    stored = {}
    for name, rows in tables.items():
        path = scratch_folder(spark, name)
        stored[name] = write_by_customer(rows, path.rsplit("/", 1)[-1].replace("-", "_"), path, BUCKETS)
    return weak_signal(stored["known"], stored["active"], _latest(stored["active"]))


# --- the log as a stream of files ----------------------------------------------------


def _as_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows as a stream of files, all of them there already."""
    path = scratch_folder(spark, "stream")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _closed(spark: SparkSession, result: DataFrame) -> DataFrame:
    """What a stream has closed when all files are read."""
    path = scratch_folder(spark, "closed")
    appended(result, f"{path}/rows", f"{path}/progress")
    return spark.read.schema(result.schema).parquet(f"{path}/rows")


@registered("stream_activity")
def stream_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaning and the activity filter over a stream of raw text."""
    raw = logs.raw_text_log(spark, folder)
    return _closed(spark, live_activity(_as_stream(spark, raw)).select(ID, TIME, KIND))


@registered("stream_daily_counts")
def stream_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Days that the watermark has passed."""
    return _closed(spark, daily_activity(_as_stream(spark, _short_activity(spark, folder))))


@registered("stream_sliding_counts")
def stream_sliding_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _closed(spark, sliding_activity(_as_stream(spark, _short_activity(spark, folder)), SHORT.windows[0]))


@registered("stream_inactivity")
def stream_inactivity(spark: SparkSession, folder: str) -> DataFrame:
    """Spells of activity that a day of silence has ended, from a source that delivers a third of its events twice."""
    log = activity_filter(logs.keyed_short_log(spark, folder))
    twice = _as_stream(spark, log.unionByName(log.where("event_id % 3 = 0")))
    return _closed(spark, inactivity_spells(delivered_once(twice, ["event_id"]), SHORT.inactive_flags[0]))


# --- labels and snapshots ------------------------------------------------------------


@registered("inactivity_label")
def inactivity_label(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    return snap.inactivity_labels(activity, snap.calendar_of(activity).anchor)


@registered("labelled_counts")
def labelled_counts(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    return snap.labelled_counts(activity, snap.calendar_of(activity).anchor)


_REGISTRY["labelled_snapshot"] = _test_snapshot


@registered("snapshot_calendar")
def snapshot_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return snap.snapshot_calendar(_activity(spark, folder))


@registered("pooled_snapshots")
def pooled_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _pooled(spark, folder, 1)[0]


@registered("pooled_snapshots_short")
def pooled_snapshots_short(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    return snap.pooled_snapshots(activity, snap.calendar_of(activity, SHORT), SHORT, first_step=0)


@registered("snapshot_summary")
def snapshot_summary(spark: SparkSession, folder: str) -> DataFrame:
    return snap.snapshot_summary(_pooled(spark, folder, 0)[0])


@registered("class_weights")
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return snap.class_weights(_pooled(spark, folder, 1)[0])


# --- matrix --------------------------------------------------------------------------


@registered("feature_matrix")
def feature_matrix_plain(spark: SparkSession, folder: str) -> DataFrame:
    return feature_matrix(_test_snapshot(spark, folder), feature_names(), [ID])


@registered("feature_matrix_log1p")
def feature_matrix_log1p(spark: SparkSession, folder: str) -> DataFrame:
    names = feature_names()
    matrix = feature_matrix(_test_snapshot(spark, folder), names, [ID], "log1p")
    return matrix.select(ID, *[F.round(c, 9).alias(c) for c in names])


@registered("constant_features")
def constant_features(spark: SparkSession, folder: str) -> DataFrame:
    names = feature_names()
    matrix = feature_matrix(_pooled(spark, folder, 1)[0], names, transform="log1p")
    return column_spread(matrix, names).withColumn("deviation", F.round("deviation", 9))


# --- scores --------------------------------------------------------------------------


@registered("risk_buckets")
def risk_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return with_buckets(_scored(_latest_features(spark, folder)))


@registered("percentile_buckets")
def percentile_buckets(spark: SparkSession, folder: str) -> DataFrame:
    activity = _activity(spark, folder)
    latest = _latest(activity)
    return percentile_scores(_scored(customer_features(activity, latest)), latest, bounded=True)


@registered("sketched_quantiles")
def quantiles_of_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """The percentile bounds of all snapshots' scores from one sketch per snapshot; estimates, so there is no SQL form."""
    sketches = quantile_sketches(_rated(spark, folder), PROBABILITY, [STEP])
    return sketched_quantiles(sketches, PERCENTILE_BOUNDS, ("p40", "p70", "p90"))


@registered("recency_distribution")
def recency_profile(spark: SparkSession, folder: str) -> DataFrame:
    return recency_distribution(_latest_features(spark, folder))


@registered("weak_signal")
def weak_signal_customers(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    return weak_signal(logs.registered_customers(spark, folder), activity, _latest(activity))


@registered("score_table")
def customer_scores(spark: SparkSession, folder: str) -> DataFrame:
    activity = _short_activity(spark, folder)
    latest = _latest(activity)
    scored = _scored(customer_features(activity, latest, SHORT), SHORT.lookback)
    return score_table(scored, weak_signal(logs.registered_customers(spark, folder), activity, latest), latest)


@registered("bucket_distribution")
def bucket_shares(spark: SparkSession, folder: str) -> DataFrame:
    return bucket_distribution(customer_scores(spark, folder).select(BUCKET))


# --- evaluation ----------------------------------------------------------------------

_PER_SNAPSHOT = [STEP, SNAPSHOT]


@registered("classification_metrics")
def threshold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return classification_metrics(_rated(spark, folder), _PER_SNAPSHOT, PROBABILITY, HORIZON.target)


@registered("roc_auc")
def ranking_auc(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranked_scores(_rated(spark, folder), _PER_SNAPSHOT, PROBABILITY, HORIZON.target, bounded=True)
    return roc_auc(ranked, _PER_SNAPSHOT).withColumn("roc_auc", F.round("roc_auc", 9))


@registered("average_precision")
def ranking_average_precision(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranked_scores(_rated(spark, folder), _PER_SNAPSHOT, PROBABILITY, HORIZON.target, bounded=True)
    return average_precision(ranked, _PER_SNAPSHOT).withColumn("pr_auc", F.round("pr_auc", 9))


def _unrounded(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked by a score that isn't rounded, so the number of scores grows with the customers: the way by ranges."""
    pooled, _ = _pooled(spark, folder, 0)
    rated = pooled.select(STEP, SNAPSHOT, HORIZON.target, _raw_score(HORIZON.lookback).alias(PROBABILITY))
    return ranked_scores(rated, _PER_SNAPSHOT, PROBABILITY, HORIZON.target, rows_per_range=SCORES_PER_RANGE)


@registered("roc_auc_unrounded")
def ranking_auc_unrounded(spark: SparkSession, folder: str) -> DataFrame:
    return roc_auc(_unrounded(spark, folder), _PER_SNAPSHOT).withColumn("roc_auc", F.round("roc_auc", 9))


@registered("average_precision_unrounded")
def ranking_average_precision_unrounded(spark: SparkSession, folder: str) -> DataFrame:
    return average_precision(_unrounded(spark, folder), _PER_SNAPSHOT).withColumn("pr_auc", F.round("pr_auc", 9))


@registered("f1_threshold_sweep")
def f1_threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    table = threshold_table(_rated(spark, folder), _PER_SNAPSHOT, PROBABILITY, HORIZON.target)
    return best_threshold(table, _PER_SNAPSHOT)


@registered("rolling_eval")
def rolling_eval(spark: SparkSession, folder: str) -> DataFrame:
    rows = rolling_evaluation(_rated(spark, folder, EVALUATED_SNAPSHOTS - 1), _PER_SNAPSHOT, PROBABILITY, HORIZON.target, bounded=True)
    rounded = rows.withColumns({c: F.round(c, 9) for c in ("roc_auc", "pr_auc")})
    return training.with_sample_flag(rounded)


@registered("run_metadata")
def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    pooled, calendar = _pooled(spark, folder, 0)
    return training.run_metadata(pooled, calendar)


# --- fitted models (no SQL form) -----------------------------------------------------


#: Where the boosted model of a session and a folder of tables is stored: four queries ask for the same one.
_FITTED: dict[tuple[str, str], str] = {}


def _boosted(spark: SparkSession, folder: str, data: training.TrainingSet | None = None) -> LeafwiseModel:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        path = scratch_folder(spark, "model")
        training.train_boosted(data or training.training_set(_activity(spark, folder))).save(spark, path)
        _FITTED[key] = path
    return LeafwiseModel.load(spark, _FITTED[key])


@registered("gbt_scores")
def boosted_scores(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    return _boosted(spark, folder, data).predict(data.test, [ID, HORIZON.target])


@registered("gbt_importance")
def boosted_feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return _boosted(spark, folder).importance(spark)


@registered("gbt_rounds")
def boosted_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """The area under the curve after each round, which decides how many trees stay."""
    return _boosted(spark, folder).rounds(spark)


@registered("level_wise_scores")
def level_wise_scores(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    return training.train_boosted(data, BoostedSettings()).predict(data.test, [ID, HORIZON.target])


@registered("level_wise_importance")
def level_wise_feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    model = training.train_boosted(data, BoostedSettings())
    return boosted_splits(spark, model).join(boosted_importance(spark, model).withColumnRenamed("importance", "gain"), "feature")


@registered("linear_calibrated_scores")
def linear_calibrated_scores(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    return training.train_linear(data).predict(data.test, [ID, HORIZON.target])


@registered("linear_importance")
def linear_feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    return linear_importance(spark, training.train_linear(data))


@registered("gbt_rolling_eval")
def model_rolling_eval(spark: SparkSession, folder: str) -> DataFrame:
    data = training.training_set(_activity(spark, folder))
    return training.evaluate(_boosted(spark, folder, data), data)
