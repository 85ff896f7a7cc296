"""Drawing a repeatable sample of customers, and the warehouse extract."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import EXTRACT_DIRECTION, EXTRACT_MONTHS, ID, SAMPLE_SIZE, TIME
from ebbtide.session import ensure_checkpoint_folder

_DIGITS = 4


def _draw(seed: int) -> Column:
    return F.md5(F.concat(F.col(ID), F.lit(f":{seed}")))


def sampled_customers(log: DataFrame, size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """``size`` distinct customers in the order of a hash, the same ones on every run.

    The log is read once: its distinct customers with their hashes are checkpointed. A hash spreads customers evenly, so the
    first digits of the last one drawn are found from a histogram of at most 65,536 rows. Customers below those digits are all drawn;
    only the few who share them are ranked in one task, however large the sample is.
    """
    ensure_checkpoint_folder(log.sparkSession)
    drawn = log.select(ID).dropna().distinct().withColumn("draw", _draw(seed)).checkpoint()
    digits = F.substring("draw", 1, _DIGITS)
    histogram = drawn.groupBy(digits.alias("digits")).agg(F.count("*").alias("n")).orderBy("digits").collect()
    below, last = 0, ""
    for row in histogram:
        last = row["digits"]
        if below + row["n"] >= size:
            break
        below += row["n"]
    sure, rest = drawn.filter(digits < last), drawn.filter(digits == last)
    return sure.unionByName(rest.orderBy("draw", ID).limit(max(0, size - below))).orderBy("draw", ID).select(ID)


def events_of(log: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows of the given customers. The optimiser broadcasts them if their measured size allows."""
    return log.join(customers, ID, "left_semi")


def extract_recent(table: DataFrame, direction_column: str, as_of: date | None = None,
                   months: int = EXTRACT_MONTHS, direction: str = EXTRACT_DIRECTION) -> DataFrame:
    """Rows of one direction from the last months. Both tests reach the source."""
    today = F.lit(as_of) if as_of else F.current_date()
    # Of the type of the stored column, so that it is the literal that is converted.
    start = F.add_months(today, -months).cast(table.schema[TIME].dataType)
    return table.filter((F.col(TIME) >= start) & (F.col(direction_column) == direction))
