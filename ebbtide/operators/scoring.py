"""The score table: buckets, action flags and customers who never engaged."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import ACTION, BUCKET, ID, PROBABILITY, RISK, SNAPSHOT, RiskLevels
from ebbtide.functions.clock import instant
from ebbtide.functions.risk import action_flag, fixed_bucket
from ebbtide.operators.activity import customers_of

SCORE_COLUMNS = (ID, SNAPSHOT, PROBABILITY, BUCKET, ACTION)


def with_buckets(scored: DataFrame, bucket: Column | None = None, levels: RiskLevels = RISK) -> DataFrame:
    """Add bucket and action flag to rows that carry a probability."""
    named = fixed_bucket(F.col(PROBABILITY), levels) if bucket is None else bucket
    return scored.withColumn(BUCKET, named).withColumn(ACTION, action_flag(F.col(BUCKET), levels))


def weak_signal(cleaned: DataFrame, activity: DataFrame, snapshot: datetime, levels: RiskLevels = RISK) -> DataFrame:
    """Customers of the cleaned log who never were active.

    Both sides are reduced to distinct customers first, so a busy one is a single row.
    """
    silent = customers_of(cleaned).join(customers_of(activity), ID, "left_anti")
    return silent.select(
        ID,
        instant(snapshot).alias(SNAPSHOT),
        F.lit(1.0).alias(PROBABILITY),
        F.lit(levels.weak_signal).alias(BUCKET),
        F.lit(1).alias(ACTION),
    )


def score_table(scored: DataFrame, silent: DataFrame | None, snapshot: datetime,
                levels: RiskLevels = RISK) -> DataFrame:
    """Scored customers, bucketed, followed by the weak-signal customers."""
    table = with_buckets(scored.withColumn(SNAPSHOT, instant(snapshot)), levels=levels).select(*SCORE_COLUMNS)
    return table if silent is None else table.unionByName(silent.select(*SCORE_COLUMNS))


def bucket_distribution(scores: DataFrame, levels: RiskLevels = RISK) -> DataFrame:
    """Customers per bucket, over the model-scored rows and over all rows."""
    weak = F.col(BUCKET) == levels.weak_signal
    counted = scores.groupBy(BUCKET).agg(F.count("*").alias("n_rows"))
    every_bucket = Window.partitionBy(F.lit(1))
    by_model = F.when(~weak, F.col("n_rows"))
    return counted.select(
        BUCKET,
        "n_rows",
        (F.col("n_rows") / F.sum("n_rows").over(every_bucket)).alias("share"),
        (by_model / F.sum(by_model).over(every_bucket)).alias("scored_share"),
    )


def recency_distribution(features: DataFrame, dormant_after: int = 90) -> DataFrame:
    """Smallest, largest and median recency, and how many customers are dormant.

    Customers are counted per recency first; the median then works on a few hundred rows.
    """
    days = F.col("recency_days")
    counted = features.groupBy("recency_days").agg(F.count("*").alias("n"))
    return counted.agg(
        F.min(days).alias("min_recency"),
        F.max(days).alias("max_recency"),
        F.percentile(days, 0.5, F.col("n")).alias("median_recency"),
        F.coalesce(F.sum(F.when(days <= dormant_after, F.col("n"))), F.lit(0)).alias("n_active"),
        F.coalesce(F.sum(F.when(days > dormant_after, F.col("n"))), F.lit(0)).alias("n_dormant"),
        F.sum("n").alias("n_customers"),
    )
