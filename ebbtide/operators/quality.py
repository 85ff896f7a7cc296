"""Row accounting for every stage."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import ID, TIME
from ebbtide.functions.clock import month_key
from ebbtide.operators.clean import BAD_TIME, EITHER_ORDER, NO_TIME


def _profile(df: DataFrame, place: int, stage: str) -> DataFrame:
    # Rows are counted per customer and month first; both distinct counts then run on those.
    grouped = df.groupBy(ID, month_key(F.col(TIME)).alias("month")).agg(
        F.count("*").alias("n"), F.min(TIME).alias("first"), F.max(TIME).alias("last")
    )
    return grouped.agg(
        F.lit(place).alias("place"),
        F.lit(stage).alias("stage"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after"),
        F.min("first").alias("first_event"),
        F.max("last").alias("last_event"),
        F.count_distinct(ID).alias("n_customers"),
        F.count_distinct("month").alias("n_months"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def data_quality(raw: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """For each stage in order: rows before, after and dropped, time range, customers, months, columns."""
    profiles = [_profile(df, i, name) for i, (name, df) in enumerate(stages.items(), start=1)]
    table = raw.agg(F.lit(0).alias("place"), F.lit("raw").alias("stage"), F.count("*").alias("rows_after"))
    for profile in profiles:
        table = table.unionByName(profile, allowMissingColumns=True)
    # One row per stage, hence a single small window.
    before = F.lag("rows_after").over(Window.partitionBy(F.lit(1)).orderBy("place"))
    return (
        table.withColumn("rows_before", before)
        .filter("place > 0")
        .select(
            "stage", "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
            "first_event", "last_event", "n_customers", "n_months", "columns",
        )
    )


def log_quality(flagged: DataFrame, stages: dict[str, Column], columns: dict[str, str]) -> DataFrame:
    """What ``data_quality`` says, and the time faults of the raw log, in one pass over it.

    ``flagged`` holds all rows in tidy form, ``stages`` tells for each stage in order which rows are left, ``columns`` names what it has. Rows are
    counted per customer and month, and those rows once by customer and once by month, which gives both distinct counts.
    """
    any_stage = reduce(or_, stages.values())
    keyed = flagged.select(
        F.when(any_stage, F.col(ID)).alias("customer"), F.when(any_stage, month_key(F.col(TIME))).alias("month"), TIME,
        NO_TIME, BAD_TIME, EITHER_ORDER, *[F.coalesce(c, F.lit(False)).alias(f"in_{i}") for i, c in enumerate(stages.values())],
    )
    faults = {"null_times": NO_TIME, "unparsed_times": BAD_TIME, "ambiguous_times": EITHER_ORDER}
    places = range(len(stages))
    inside = lambda i: F.when(F.col(f"in_{i}"), F.col(TIME))
    grouped = keyed.groupBy("customer", "month").agg(
        F.count("*").alias("raw"), *[F.count_if(F.col(c)).alias(n) for n, c in faults.items()],
        *[F.count_if(F.col(f"in_{i}")).alias(f"n_{i}") for i in places],
        *[F.min(inside(i)).alias(f"first_{i}") for i in places], *[F.max(inside(i)).alias(f"last_{i}") for i in places],
    )
    sums = [F.sum(c).alias(c) for c in ("raw", *faults, *(f"n_{i}" for i in places))]
    ends = [f(f"{n}_{i}").alias(f"{n}_{i}") for i in places for f, n in ((F.min, "first"), (F.max, "last"))]
    customer, month = F.col("customer"), F.col("month")
    sides = grouped.groupingSets([[customer], [month]], customer, month).agg(F.grouping("month").alias("of_customer"), *sums, *ends)
    by_customer = F.col("of_customer") == 1
    total = lambda c: F.coalesce(F.sum(F.when(by_customer, F.col(c))), F.lit(0)).cast("long").alias(c)
    one = sides.agg(
        *[total(c) for c in ("raw", *faults, *(f"n_{i}" for i in places))], *ends,
        *[F.count_if(by_customer & (F.col(f"n_{i}") > 0) & customer.isNotNull()).alias(f"customers_{i}") for i in places],
        *[F.count_if(~by_customer & (F.col(f"n_{i}") > 0)).alias(f"months_{i}") for i in places],
    )
    lines = []
    for i, name in enumerate(stages):
        before = F.col("raw" if i == 0 else f"n_{i - 1}")
        lines.append(F.struct(
            F.lit(name).alias("stage"), before.alias("rows_before"), F.col(f"n_{i}").alias("rows_after"),
            (before - F.col(f"n_{i}")).alias("rows_dropped"), F.col(f"first_{i}").alias("first_event"), F.col(f"last_{i}").alias("last_event"),
            F.col(f"customers_{i}").alias("n_customers"), F.col(f"months_{i}").alias("n_months"), F.lit(columns[name]).alias("columns"),
        ))
    return one.select(F.inline(F.array(*lines)), *faults)
