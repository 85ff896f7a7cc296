"""From logs and a fitted model to the score table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import HORIZON, ID, PERCENTILE_BOUNDS, PROBABILITY, RISK, SNAPSHOT, Horizon, RiskLevels
from ebbtide.functions.clock import instant
from ebbtide.functions.risk import bucket_by
from ebbtide.models.risk_model import RiskModel
from ebbtide.operators.features import customer_features
from ebbtide.operators.ranking import exact_quantiles
from ebbtide.operators.scoring import SCORE_COLUMNS, score_table, weak_signal, with_buckets


def score_customers(model: RiskModel, activity: DataFrame, snapshot: datetime, horizon: Horizon = HORIZON,
                    history: str = "full") -> DataFrame:
    """Probability per customer. ``history="lookback"`` leaves out those not seen in the lookback."""
    features = customer_features(activity, snapshot, horizon, history=history)
    return model.predict(features, [ID])


def scores_with_weak_signals(model: RiskModel, cleaned: DataFrame, activity: DataFrame, snapshot: datetime,
                             horizon: Horizon = HORIZON) -> DataFrame:
    scored = score_customers(model, activity, snapshot, horizon)
    return score_table(scored, weak_signal(cleaned, activity, snapshot), snapshot)


def percentile_bounds(scored: DataFrame, bounded: bool = False) -> DataFrame:
    """The 40th, 70th and 90th percentile of the probability: one row."""
    return exact_quantiles(scored, PROBABILITY, PERCENTILE_BOUNDS, ("p40", "p70", "p90"), bounded=bounded)


def percentile_scores(scored: DataFrame, snapshot: datetime, bounded: bool = False,
                      levels: RiskLevels = RISK) -> DataFrame:
    """The earlier score table: buckets relative to the scored customers. Three numbers come to the driver."""
    limits = percentile_bounds(scored, bounded).first()
    bucket = bucket_by(F.col(PROBABILITY), *[F.lit(limits[n]) for n in ("p40", "p70", "p90")], levels)
    timed = scored.withColumn(SNAPSHOT, instant(snapshot))
    return with_buckets(timed, bucket, levels).select(*SCORE_COLUMNS)


def thresholds_record(spark: SparkSession, snapshot: datetime, levels: RiskLevels = RISK) -> DataFrame:
    """The bucket limits of a run, as one row to be stored beside the scores."""
    # Texts of the record.
    rule = "high_or_very_high_or_weak_signal"
    note = "Customers who NEVER had activity events (only bounce/cancel/unsub)"
    return spark.range(1).select(
        instant(snapshot).alias("snapshot_time"),
        F.lit(levels.very_high).alias("threshold_very_high"),
        F.lit(levels.high).alias("threshold_high"),
        F.lit(levels.medium).alias("threshold_medium"),
        F.lit(rule).alias("action_rule"),
        F.lit(note).alias("weak_signal_note"),
    )
