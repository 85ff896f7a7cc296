"""The stages in order, each from stored data to stored data.

Every function takes its paths from the caller and leaves a table behind that the
next one reads, so that a lost executor or driver costs one stage at most.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import HORIZON, ID, BoostedSettings, Horizon, LeafwiseSettings, LinearSettings
from ebbtide.models.importance import linear_importance, split_counts
from ebbtide.models.leafwise import LeafwiseModel
from ebbtide.models.risk_model import RiskModel
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.clean import CLEAN, LENIENT, CleaningProfile, clean_events, decided_order, flagged_events, normalise_log
from ebbtide.operators.metrics import average_precision, ranked_scores, roc_auc
from ebbtide.operators.quality import data_quality, log_quality
from ebbtide.operators.snapshots import SnapshotCalendar, calendar_of, labelled_counts, observed_range, pooled_snapshots
from ebbtide.plans import scoring_run, training
from ebbtide.sources.activity_store import window_of, write_by_month
from ebbtide.sources.readers import path_exists, read_raw_csv, require_path
from ebbtide.sources.sinks import write_csv, write_json, write_parquet

Model = RiskModel | LeafwiseModel


def load_model(spark: SparkSession, folder: str) -> Model:
    """A saved model of any kind."""
    return (LeafwiseModel if path_exists(spark, f"{folder}/leafwise") else RiskModel).load(spark, folder)


def clean_stage(spark: SparkSession, raw_csv: str, cleaned: str, profile: CleaningProfile = LENIENT,
                as_of: datetime | None = None, day_first: bool | None = None) -> DataFrame:
    """Raw CSV to the cleaned log. Returns the row accounting with the null, unparsed and ambiguous times, and whether the day came first.

    Where ``day_first`` is not given, the whole log decides: the day comes first if some times can't be read otherwise and none
    says the opposite. ambiguous_times counts times that another order would change.
    """
    require_path(spark, raw_csv, "the raw log is the first input")
    raw = read_raw_csv(spark, raw_csv, all_columns=not profile.keep_only_known)
    if day_first is None:
        day_first = decided_order(raw)
    as_of = as_of or datetime.now(timezone.utc)
    write_parquet(clean_events(raw, profile, as_of, day_first), cleaned)
    names = {"clean": ", ".join(spark.read.parquet(cleaned).columns)}
    flagged = flagged_events(raw, profile, as_of, day_first)
    return log_quality(flagged, {"clean": F.col(CLEAN)}, names).withColumn("day_first", F.lit(day_first))


def activity_stage(spark: SparkSession, cleaned: str, activity: str) -> DataFrame:
    """Cleaned log to activity log."""
    require_path(spark, cleaned, "run the clean stage first")
    log = spark.read.parquet(cleaned)
    write_parquet(activity_filter(log, respell=True), activity)
    return data_quality(log, {"activity": spark.read.parquet(activity)})


def month_stage(spark: SparkSession, activity: str, dataset: str) -> None:
    """Activity log to the dataset with a folder per month."""
    require_path(spark, activity, "run the activity stage first")
    write_by_month(normalise_log(spark.read.parquet(activity)), dataset)


def label_stage(spark: SparkSession, activity: str, labelled: str, horizon: Horizon = HORIZON) -> None:
    """Activity log to one labelled feature table at the last snapshot with a full outcome window."""
    require_path(spark, activity, "run the activity stage first")
    log = normalise_log(spark.read.parquet(activity))
    write_parquet(labelled_counts(log, calendar_of(log, horizon).anchor, horizon), labelled)


def needed_events(log: DataFrame, calendar: SnapshotCalendar, horizon: Horizon = HORIZON) -> DataFrame:
    """The rows that the snapshots of a calendar look at; tables by month are read for those months only."""
    oldest = calendar.anchor - timedelta(days=calendar.pooled * horizon.step + horizon.lookback)
    return normalise_log(window_of(log, oldest, calendar.anchor + timedelta(days=horizon.outcome)))


def train_stage(spark: SparkSession, dataset: str, folder: str, kind: str = "boosted", horizon: Horizon = HORIZON,
                settings: LeafwiseSettings | BoostedSettings | LinearSettings | None = None, limit: int = 0) -> Model:
    """Activity by month to a model with its features, evaluation, importances and run record in ``folder``.

    ``kind`` is boosted or linear. Boosted trees grow the best leaf first, and with ``BoostedSettings`` by level, as MLlib's do.
    """
    if kind not in ("boosted", "linear"):
        raise ValueError("kind is 'boosted' or 'linear'")
    require_path(spark, dataset, "run the month stage first")
    log = spark.read.parquet(dataset)
    calendar = calendar_of(normalise_log(log), horizon, limit)
    write_parquet(pooled_snapshots(needed_events(log, calendar, horizon), calendar, horizon, first_step=0), f"{folder}/training_rows")
    data = training.TrainingSet(spark.read.parquet(f"{folder}/training_rows"), calendar, horizon)
    if data.calendar.pooled < 1:
        raise ValueError("no snapshot has enough history for pooled training")
    settings = settings or (LeafwiseSettings() if kind == "boosted" else LinearSettings())
    model = (training.train_boosted if kind == "boosted" else training.train_linear)(data, settings)
    model.save(spark, f"{folder}/model")
    if isinstance(model, LeafwiseModel):
        importance = model.importance(spark).select("feature", "importance")
        write_csv(model.rounds(spark).coalesce(1), f"{folder}/rounds")
    elif kind == "boosted":
        importance = split_counts(spark, f"{folder}/model", model.features)
    else:
        importance = linear_importance(spark, model)
    write_csv(training.evaluate(model, data), f"{folder}/rolling_eval")
    write_csv(importance.coalesce(1), f"{folder}/feature_importance")
    record = training.run_metadata(data.rows, calendar, horizon, len(model.features))
    tested = model.predict(data.test, [ID, horizon.target])
    ranked = ranked_scores(tested, [], scoring_run.PROBABILITY, horizon.target)
    record = record.withColumns({
        "model": F.lit(kind),
        "parameters": F.lit(json.dumps(asdict(settings))),
        "pool_limit": F.lit(limit),
        "roc_auc_test": roc_auc(ranked, []).scalar(),
        "pr_auc_test": average_precision(ranked, []).scalar(),
    })
    write_json(record, f"{folder}/train_meta")
    return model


def score_stage(spark: SparkSession, folder: str, cleaned: str, activity: str, scores: str,
                horizon: Horizon = HORIZON) -> DataFrame:
    """Model and logs to the score table, as Parquet and CSV, with the bucket limits beside the model."""
    require_path(spark, activity, "run the activity stage first")
    require_path(spark, f"{folder}/model", "run the train stage first")
    model = load_model(spark, f"{folder}/model")
    log = normalise_log(spark.read.parquet(activity))
    latest = observed_range(log)[1]
    known = spark.read.parquet(require_path(spark, cleaned, "run the clean stage first"))
    write_parquet(scoring_run.scores_with_weak_signals(model, known, log, latest, horizon), f"{scores}/parquet")
    stored = spark.read.parquet(f"{scores}/parquet")
    write_csv(stored, f"{scores}/csv")
    write_json(scoring_run.thresholds_record(spark, latest), f"{folder}/bucket_thresholds")
    return stored
