"""Which rows are activity, and how they are counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, MONTH, REQUIRED, TIME, VOCABULARY, Vocabulary
from ebbtide.functions.clock import month_key
from ebbtide.functions.text import strip


def is_activity(vocabulary: Vocabulary = VOCABULARY) -> Column:
    """The test on a kind in lower case."""
    kind = F.col(KIND)
    return kind.isin(*vocabulary.exact) | kind.startswith(vocabulary.prefix)


def activity_filter(log: DataFrame, vocabulary: Vocabulary = VOCABULARY, respell: bool = False) -> DataFrame:
    """Keep activity rows.

    A cleaned log is spelled in lower case already, so the test is put on the stored
    column and reaches the scan. ``respell`` is for logs that were not cleaned here.
    """
    if respell:
        log = log.withColumn(KIND, F.lower(strip(F.col(KIND).cast("string"))))
    return log.filter(is_activity(vocabulary))


def with_month(log: DataFrame) -> DataFrame:
    """The three core columns of valid rows, and their calendar month."""
    valid = log.select(*REQUIRED).dropna()
    return valid.withColumn(MONTH, month_key(F.col(TIME)))


def month_partitions(log: DataFrame) -> DataFrame:
    """Rows and time range of each calendar month."""
    return (
        with_month(log)
        .groupBy(MONTH)
        .agg(
            F.count("*").alias("n_rows"),
            F.min(TIME).alias("first_event"),
            F.max(TIME).alias("last_event"),
        )
        .orderBy(MONTH)
    )


def counts_with_share(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, absolute and as a share of all rows.

    The total is taken over the counted rows, of which there are as many as values.
    """
    counted = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return counted.select(column, "n_rows", (F.col("n_rows") / total).alias("share"))


def customers_of(log: DataFrame) -> DataFrame:
    """Every customer once."""
    return log.select(strip(F.col(ID)).alias(ID)).dropna().distinct()
