"""Risk buckets and action flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.config import RISK, RiskLevels


def bucket_by(probability: Column, medium: Column, high: Column, very_high: Column,
              levels: RiskLevels = RISK) -> Column:
    """Bucket name by lower bounds. Spark sorts NaN above all numbers, so it is sent to the last name."""
    worst, bad, middling, best = levels.names
    return (
        F.when(probability.isNull() | F.isnan(probability), best)
        .when(probability >= very_high, worst)
        .when(probability >= high, bad)
        .when(probability >= medium, middling)
        .otherwise(best)
    )


def fixed_bucket(probability: Column, levels: RiskLevels = RISK) -> Column:
    return bucket_by(probability, F.lit(levels.medium), F.lit(levels.high), F.lit(levels.very_high), levels)


def action_flag(bucket: Column, levels: RiskLevels = RISK) -> Column:
    return bucket.isin(*levels.acted_on, levels.weak_signal).cast("int")
