"""The activity log stored by calendar month."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import DAY, ID, KIND, MONTH, REQUIRED, TIME
from ebbtide.functions.clock import as_instant, moment_like, utc_naive
from ebbtide.operators.activity import with_month
from ebbtide.sources.readers import path_exists


def _write_months(log: DataFrame, path: str, mode: str) -> None:
    """``rebalance`` lets the adaptive planner split a month that is too large for one task
    and join small ones. The date column is there for its file statistics: file readers
    skip row groups on dates, but not on zone-free timestamps.
    """
    dated = with_month(log).withColumn(DAY, F.to_date(TIME))
    (
        dated.hint("rebalance", F.col(MONTH))
        .sortWithinPartitions(MONTH, TIME)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(MONTH)
        .parquet(path)
    )


def write_by_month(log: DataFrame, path: str) -> None:
    """Replace the dataset at ``path`` with one folder per month."""
    _write_months(log, path, "static")


def replace_months(log: DataFrame, path: str) -> None:
    """Replace the months that ``log`` has rows of; all other months of the dataset stay as they are, unread.

    The new files are written aside and put in place when all tasks are done, so a failed run leaves the old months. ``log`` must not be read
    from the folders that it replaces: store it first.
    """
    _write_months(log, path, "dynamic")


def drop_months(spark: SparkSession, path: str, months: list[str]) -> None:
    """Remove whole months, for example those that a rewritten log has no rows of any more."""
    for month in months:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={month}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark.catalog.refreshByPath(path)


def months_between(start: datetime, end: datetime) -> list[str]:
    """Every calendar month from one instant to another, as ``yyyy-MM``."""
    start, end = utc_naive(start), utc_naive(end)
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def window_of(log: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows in (start, end].

    The time test alone cannot prune folders or row groups, so the months and dates it
    implies are added for tables that have those columns.
    """
    kinds = {f.name: f.dataType for f in log.schema}
    time = F.col(TIME)
    test = (time > moment_like(kinds[TIME], start)) & (time <= moment_like(kinds[TIME], end))
    if MONTH in kinds:
        test = F.col(MONTH).isin(*months_between(start, end)) & test
    if DAY in kinds:
        first, last = utc_naive(start).date(), utc_naive(end).date()
        test = test & F.col(DAY).between(F.lit(first), F.lit(last))
    return log.filter(test).select(ID, as_instant(time, kinds[TIME]).alias(TIME), KIND).dropna()


def _plain_months(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    """A dataset whose folders are bare month names: only the named folders are listed."""
    found = [f"{path}/{month}" for month in months if path_exists(spark, f"{path}/{month}")]
    if not found:
        empty = f"{ID} string, {TIME} timestamp_ntz, {KIND} string"
        return spark.createDataFrame([], empty)
    return spark.read.parquet(*found).select(*REQUIRED)


def load_events(spark: SparkSession, dataset: str, start: datetime, end: datetime,
                single_file: str | None = None, bare_folders: bool = False) -> DataFrame:
    """Activity in (start, end] from the monthly dataset, or from one file where there is none."""
    if path_exists(spark, dataset):
        if bare_folders:
            return window_of(_plain_months(spark, dataset, months_between(start, end)), start, end)
        return window_of(spark.read.parquet(dataset), start, end)
    if single_file and path_exists(spark, single_file):
        return window_of(spark.read.parquet(single_file), start, end)
    raise FileNotFoundError(f"no activity data: neither {dataset} nor {single_file} exists")
